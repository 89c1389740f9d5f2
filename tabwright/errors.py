"""Exceptions raised by the operators."""


class ValidationFailure(ValueError):
    """A table broke one or more validation rules; lists every broken rule."""

    def __init__(self, problems):
        self.problems = tuple(problems)
        super().__init__(
            "table failed validation:\n" + "\n".join(f"- {p}" for p in self.problems)
        )


class StrictInputError(ValueError):
    """A scoring input broke the strict source contract."""


class ArtifactError(ValueError):
    """A saved model or its manifest is incomplete or inconsistent."""
