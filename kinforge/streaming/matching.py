"""Candidates for records of the first source that arrive as a stream, against stored candidates."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..operators import ranking
from ..plans.blocking import Blocking, CandidateIndex
from ..schema import BlockingConfig
from ..sources.shared import scope, stage


def stream_candidates(arriving: DataFrame, candidates: DataFrame | CandidateIndex, config: BlockingConfig, sink: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Block, rank and cap each micro-batch of records against the stored candidates and hand it to sink.

    arriving and candidates: source, entity_id, name, address, country. The candidates are indexed once; a batch costs
    its own records, and its staged tables go with it, so sink must write or collect what it is given. A batch that is
    run again gives the same rows, so a sink that writes by batch number keeps each batch once.
    """

    index = candidates if isinstance(candidates, CandidateIndex) else CandidateIndex.build(stage(candidates, "candidates"), config)

    index.keyed  # noqa: B018 - staged now, as what a batch stages goes with it

    def one(batch: DataFrame, number: int) -> None:
        with scope(batch.sparkSession):
            sink(ranking.ranked(Blocking(batch, config, index).found(config.max_candidates_per_source)), number)

    return arriving.writeStream.option("checkpointLocation", checkpoint).foreachBatch(one).start()
