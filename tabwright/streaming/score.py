"""Continuous scoring: the same row-local plan on a streaming DataFrame."""

from __future__ import annotations

from tabwright.plans.inference import Resources, score_with_recipe


def score_stream(
    stream,
    resources: Resources,
    output: str,
    checkpoint: str,
    *,
    available_now: bool = True,
    **options,
):
    """Start scoring ``stream`` into Parquet files at ``output``.

    Progress is kept in ``checkpoint`` on shared storage, so a restarted query
    goes on where it stopped and each row is written once. No state is kept.
    """
    if not stream.isStreaming:
        raise ValueError("score_stream needs a streaming DataFrame")
    scored = score_with_recipe(stream, resources, **options).frame
    writer = (
        scored.writeStream.format("parquet")
        .outputMode("append")
        .option("path", output)
        .option("checkpointLocation", checkpoint)
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
