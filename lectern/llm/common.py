"""What the operators share: Arrow batches of bounded size, text helpers, row keys."""

from __future__ import annotations

import hashlib
import os
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.session import ensure_checkpoint_dir, settle, ship, tune

# rows of one Arrow batch: with whole texts in them, batches stay a few MB
BATCH_ROWS = 256

# the white space that parts words, as byte values: space, tab to carriage return
BLANKS = bytes([0x20, *range(0x09, 0x0E)])
WORD = r"[^\x20\x09-\x0D]+"


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings for the operators, the package on the workers, the shared folder."""
    ship(tune(spark))
    ensure_checkpoint_dir(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def by_batch(frame: DataFrame, schema: str, work: Callable[[pa.RecordBatch], Iterable[dict]]) -> DataFrame:
    """Apply ``work`` to every Arrow batch; it gives columns (name to values) of the schema."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        for batch in batches:
            if batch.num_rows:
                yield from work(batch)

    return frame.mapInArrow(run, schema)


def strings(column: pa.Array) -> list[str | None]:
    return column.to_pylist()


def free_names(frame: DataFrame, *stems: str) -> list[str]:
    """Names like ``stems`` that no column of ``frame`` has, in any spelling."""
    taken, found = {name.lower() for name in frame.columns}, []
    for stem in stems:
        name, number = f"_{stem}", 0
        while name.lower() in taken:
            number += 1
            name = f"_{stem}_{number}"
        found.append(name)
    return found


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def text_key(text: Column) -> Column:
    """Rows whose texts are equal share this key; null counts as empty."""
    return F.sha2(F.coalesce(text.cast("string"), F.lit("")), 256)


def word_count(text: Column) -> Column:
    """Number of words of a text (null: 0), without a list of them."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


# bits of a key filter, and of one of its rows: at most 2,048 rows of 4 KB, whatever the data
FILTER_BITS, FILTER_ROW = 1 << 26, 1 << 15


def _bit(key: str) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(FILTER_BITS))


def key_filter(keys: DataFrame, key: str) -> DataFrame:
    """A bitmap of the hashed keys in rows of ``FILTER_ROW`` bits, for ``with_filter``; a null key counts as one."""
    return keys.select(_bit(key).alias("_bit")).groupBy(F.floor(F.col("_bit") / FILTER_ROW).alias("_part")).agg(
        F.bitmap_construct_agg(F.pmod("_bit", F.lit(FILTER_ROW))).alias("_bits"))


def with_filter(rows: DataFrame, found: DataFrame, key: str, name: str) -> DataFrame:
    """``rows`` with a boolean ``name``: false only where the key is surely not in the filter."""
    place = F.pmod(_bit(key), F.lit(FILTER_ROW))
    byte = F.conv(F.hex(F.substring(F.col("_bits"), F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    is_set = F.pmod(F.floor(byte / F.pow(F.lit(2), F.pmod(place, F.lit(8)))), F.lit(2)) == 1
    joined = rows.withColumn("_part", F.floor(_bit(key) / FILTER_ROW)).join(F.broadcast(found), "_part", "left")
    return joined.select(*rows.columns, F.coalesce(is_set, F.lit(False)).alias(name))


def concatenated(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a batch in one array, and the offsets of the texts in it."""
    lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    offsets = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum(lengths, out=offsets[1:])
    return np.frombuffer(b"".join(texts), dtype=np.uint8), offsets


def mix(values: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: spreads every input bit over all output bits."""
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values = values ^ (values >> np.uint64(27))
    values = values * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


__all__ = ["BATCH_ROWS", "BLANKS", "WORD", "by_batch", "concatenated", "free_names", "key_filter", "mix", "prepare", "settle", "sha",
           "strings", "text_key", "with_filter", "word_count"]
