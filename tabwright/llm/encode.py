"""Word-cached encoding with a public tokenizer that never merges across white space."""

from __future__ import annotations

import os

import numpy as np

#: Words kept per task; the cache starts anew beyond it, which costs time and changes nothing.
CACHED_WORDS = 700_000


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class WordEncoder:
    """Encodes texts as 32-bit little-endian ids, each distinct word once.

    The tokenizer lower-cases, drops white space and splits letters from marks before it
    merges, so the ids of a text are those of its words one after the other, and a final
    full stop or comma after letters has ids of its own.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        pieces = self.tokenizer.get_vocab(with_added_tokens=False)
        self.is_end = np.zeros(max(pieces.values()) + 1, bool)
        self.is_end[[i for piece, i in pieces.items() if piece.endswith("</w>")]] = True
        self.special = [s.content.encode() for s in self.tokenizer.get_added_tokens_decoder().values()]
        self.known: dict[bytes, bytes] = {}
        self.tails = {mark: self._ids([mark])[0] for mark in ".,"}

    def _ids(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, "<u4").tobytes() for x in found]

    def _letters(self, words: list[str]) -> list[bytes]:
        """Ids of words of letters alone, encoded many at once and cut at word ends."""
        joined = np.frombuffer(self._ids([" ".join(words)])[0], "<u4")
        ends = np.flatnonzero(self.is_end[joined]) + 1
        if len(ends) != len(words):
            return self._ids(words)
        data, out, start = joined.tobytes(), [], 0
        for end in (4 * ends).tolist():
            out.append(data[start:end])
            start = end
        return out

    def learn(self, words: set[bytes]) -> None:
        new = list(words.difference(self.known))
        if len(self.known) + len(new) > CACHED_WORDS:
            self.known, new = {}, list(words)
        plain: dict[str, bytes] = {}
        marked, other = [], []
        for word, text in zip(new, b" ".join(new).decode("utf-8").split(" ") if new else ()):
            if text.isalpha():
                plain[text] = word
            elif text[-1] in ".," and (core := text[:-1]).isalpha():
                marked.append((word, word[:-1], text[-1]))
                if word[:-1] not in self.known:
                    plain[core] = word[:-1]
            else:
                other.append((word, text))
        names = list(plain)
        for at in range(0, len(names), 2000):
            part = names[at : at + 2000]
            self.known.update(zip(map(plain.__getitem__, part), self._letters(part)))
        for word, core, mark in marked:
            self.known[word] = self.known[core] + self.tails[mark]
        for at in range(0, len(other), 20_000):
            part = other[at : at + 20_000]
            for (word, _), ids in zip(part, self._ids([text for _, text in part])):
                self.known[word] = ids

    def encode(self, bodies: list[bytes]) -> list[bytes]:
        """Ids of each text; one that may spell a special token is encoded as a whole."""
        lowered = [body.lower() for body in bodies]
        whole = {i for i, body in enumerate(lowered) if any(s in body for s in self.special)}
        words = [() if i in whole else body.split() for i, body in enumerate(lowered)]
        self.learn(set().union(*words))
        find = self.known.__getitem__
        out = [b"".join(map(find, each)) for each in words]
        for i in whole:
            out[i] = self._ids([bodies[i].decode("utf-8")])[0]
        return out
