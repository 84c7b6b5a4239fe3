"""Records that micro-batches leave for later ones, as files below the shared folder."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from rillhouse.session import drop_folder

_MARK = "latest ARRAY<BIGINT>, kept MAP<BIGINT, BIGINT>, gone ARRAY<BIGINT>"


@dataclass
class Standing:
    """What holds after a batch: the latest time of each input so far, in microseconds, and the
    batches whose records are still kept, with the time until when they are."""

    latest: list[int | None]
    kept: dict[int, int] = field(default_factory=dict)
    gone: list[int] = field(default_factory=list)

    def after(self, fresh: Sequence[int | None]) -> list[int | None]:
        pairs = zip(self.latest, fresh, strict=True)
        return [max((t for t in pair if t is not None), default=None) for pair in pairs]


def watermark(latest: Sequence[int | None], late_us: int) -> int | None:
    """The engine's rule: the least of the inputs' latest times, in whole milliseconds."""
    if any(t is None for t in latest):
        return None
    return min(latest) // 1000 * 1000 - late_us


class Held:
    """Records that wait for the watermark, by the micro-batch they came in.

    A batch reads what the batches before it left and writes folders of its own, so that it does the
    same if it is repeated. Folders that no later batch can need are dropped once the batch that
    found this is over. Records are written once, however many batches they wait.
    """

    def __init__(self, path: str):
        self.path = path

    def before(self, spark: SparkSession, batch_id: int, inputs: int = 1) -> Standing:
        if not batch_id:
            return Standing([None] * inputs)
        mark = spark.read.schema(_MARK).parquet(f"{self.path}/marks/{batch_id - 1}").first()
        return Standing(list(mark.latest), dict(mark.kept), list(mark.gone))

    def note(
        self, spark: SparkSession, batch_id: int, before: Standing, latest: Sequence[int | None],
        until: int | None, mark: int | None,
    ) -> None:
        """The standing after a batch. Its records, if any, are kept ``until`` the watermark has
        passed that time."""
        known = before.kept if until is None else {**before.kept, batch_id: until}
        kept = {k: t for k, t in known.items() if mark is None or t > mark}
        row = (list(latest), kept, [k for k in known if k not in kept])
        spark.createDataFrame([row], _MARK).coalesce(1).write.mode("overwrite").parquet(
            f"{self.path}/marks/{batch_id}"
        )
        for batch in before.gone:
            drop_folder(spark, f"{self.path}/rows/{batch}")
        drop_folder(spark, f"{self.path}/marks/{batch_id - 2}")

    def keep(self, rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(f"{self.path}/rows/{batch_id}")

    def read(
        self, spark: SparkSession, schema: T.StructType, kept: Mapping[int, int]
    ) -> DataFrame | None:
        """The records of the batches ``kept``; None if there are none."""
        paths = [f"{self.path}/rows/{batch}" for batch in sorted(kept)]
        return spark.read.schema(schema).parquet(*paths) if paths else None
