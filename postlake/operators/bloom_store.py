"""A Bloom filter kept between runs (D2): its bits are a stored table.

The table has one row per filled piece of the filter, ``(layer, bucket,
bits)``: Spark's ``bitmap_construct_agg`` makes a piece of 32,768 bits from a
batch's positions, ``bitmap_or_agg`` merges it with the stored one, and items
are tested by a join on (layer, bucket) of their positions.

A filter made for ``capacity`` items would fill up, so layers are added: each
holds twice the items of the one before at half its error rate, and an item is
known if any layer knows it.  The error rates add up to at most ``error``, and
the number of layers grows with the logarithm of the items.

Each batch writes its pieces as a new version beside the old ones; a version is
complete once its row in ``log`` is written, and a batch that is replayed
(same ``batch_id``) returns the decisions written the first time.  Only the
pieces that a batch touches are rewritten; others stay with their version.

Cases: a null item is an item; equal items of a batch are one.  An empty batch
adds nothing.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlake.operators.sketches import bloom_size, hash_positions

CAPACITY = 1_000_000
ERROR = 0.01
#: Bits of one piece (fixed by ``bitmap_construct_agg``).
PIECE = 32_768
_PIECES = "layer int, bucket long, bits binary, batch_id long"
_LOG = "batch_id long, layer int, items long"


@dataclass
class BloomStore:
    """A filter stored below ``path``."""
    spark: SparkSession
    path: str
    capacity: int = CAPACITY
    error: float = ERROR

    def layer_size(self, layer: int) -> tuple[int, int]:
        """(bits, hashes): capacity doubles, the error halves from error / 2."""
        return bloom_size(self.capacity << layer, self.error / 2 ** (layer + 1))

    def _read(self, part: str, schema: str) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(f"{self.path}/{part}")
        except Exception as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            return self.spark.createDataFrame([], schema)

    def log(self) -> dict[int, tuple[int, int]]:
        """batch_id -> (layer it filled, items in that layer after it); one row a batch."""
        return {r.batch_id: (r.layer, r.items) for r in self._read("log", _LOG).collect()}

    def pieces(self, before: int) -> DataFrame:
        """The newest version of each piece of batches before ``before``."""
        rows = self._read("pieces", _PIECES).where(F.col("batch_id") < before)
        newest = rows.groupBy("layer", "bucket").agg(F.max("batch_id").alias("batch_id"))
        return rows.join(newest, ["layer", "bucket", "batch_id"]).select("layer", "bucket", "bits")

    def _positions(self, items: DataFrame, layers: list[int]) -> DataFrame:
        """(item, layer, bucket, bit) of every item in each of ``layers``."""
        key = F.concat(F.lit(":"), F.coalesce(F.concat(F.lit("="), F.col("item").cast("string")), F.lit("")))

        def places(n):
            bits, hashes = self.layer_size(n)
            return F.transform(hash_positions(F.concat(F.lit(str(n)), key), hashes, bits), lambda p: F.struct(F.lit(n).alias("layer"), p.alias("at")))

        each = F.array(*map(places, layers))
        rows = items.select("item", F.explode(F.flatten(each)).alias("p"))
        return rows.select("item", F.col("p.layer").alias("layer"), F.expr(f"p.at div {PIECE}").alias("bucket"),
                           (F.col("p.at") % PIECE).cast("int").alias("bit"))

    def known(self, items: DataFrame, before: int | None = None) -> DataFrame:
        """``item, known`` for the distinct items of column ``item``."""
        log = self.log()
        before = max(log, default=-1) + 1 if before is None else before
        items = items.select("item").distinct()
        layers = sorted({n for b, (n, _) in log.items() if b < before})
        if not layers:
            return items.withColumn("known", F.lit(False))
        # A layer is full long before its last piece is; pieces without a bit are not stored.
        at = self._positions(items, layers).join(self.pieces(before), ["layer", "bucket"], "left")
        byte = F.conv(F.hex(F.substring("bits", F.expr("bit div 8 + 1").cast("int"), F.lit(1))), 16, 10).cast("int")
        hit = F.coalesce(F.call_function("getbit", byte, F.col("bit") % 8) == 1, F.lit(False))
        per_layer = at.groupBy("item", "layer").agg(F.min(hit).alias("hit"))
        return per_layer.groupBy("item").agg(F.max("hit").alias("known"))

    def add(self, items: DataFrame, batch_id: int) -> DataFrame:
        """Tests the batch's items, adds the new ones and returns ``item,
        accepted`` (accepted: not known before this batch)."""
        log = self.log()
        decided = f"{self.path}/decisions/batch_id={batch_id}"
        if batch_id not in log:
            before = [x for b, x in sorted(log.items()) if b < batch_id]
            layer, filled = before[-1] if before else (0, 0)
            (self.known(items, batch_id).select("item", (~F.col("known")).alias("accepted")).write.mode("overwrite").parquet(decided))
            new = self.spark.read.parquet(decided).where("accepted")
            n = new.count()
            # The first layer that the batch leaves within its capacity; a batch
            # is never split over layers, so a layer's error holds.
            while filled and filled + n > self.capacity << layer or n > self.capacity << layer:
                layer, filled = layer + 1, 0
            fresh = (self._positions(new, [layer]).groupBy("layer", "bucket").agg(F.bitmap_construct_agg("bit").alias("bits")))
            old = self.pieces(batch_id).where(F.col("layer") == layer).join(fresh.select("layer", "bucket"), ["layer", "bucket"], "left_semi")
            merged = fresh.unionByName(old).groupBy("layer", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
            merged.write.mode("overwrite").parquet(f"{self.path}/pieces/batch_id={batch_id}")
            entry = self.spark.createDataFrame([(layer, filled + n)], "layer int, items long")
            entry.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/log/batch_id={batch_id}")
        return self.spark.read.parquet(decided)
