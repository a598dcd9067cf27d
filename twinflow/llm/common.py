"""Column helpers that several corpus operators share.

All of them are native expressions; a null text counts as empty.
"""

import gc
import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from twinflow.session import fresh_dir

# the separators of the contracts: blank, tab, LF, VT, FF, CR
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def text_of(col: str | Column = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def words_of(text: Column) -> Column:
    """Words in order; an empty array where there are none."""
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, UPPER.lower())


def remainder(doc_id: str | Column, of: int) -> Column:
    """crc32 of the id as text, modulo ``of``; null ids are their own text."""
    key = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % of


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def size_in_words(text: Column) -> Column:
    """Number of words, without building them.

    A word starts at the first character or after a separator, so runs of
    other characters shrink to one mark each and the marks are counted.
    """
    return F.length(F.regexp_replace(F.regexp_replace(text, WORD, "x"), SPACE, "")).cast("long")


def free_name(df: DataFrame, name: str) -> str:
    """A name for a working column that no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name = f"_{name}"
    return name


class Scratch:
    """Tables written once in the shared folder, and given up when their readers are done.

    A step's shuffle files stay until the driver collects its garbage; ``free`` asks for that, so that a job
    of many steps holds the disk of one.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.folders: dict[int, str] = {}

    def keep(self, df: DataFrame, label: str) -> DataFrame:
        folder = fresh_dir(self.spark, label)
        df.write.parquet(folder)
        written = self.spark.read.schema(df.schema).parquet(folder)
        self.folders[id(written)] = folder
        return written

    def free(self, *tables: DataFrame) -> None:
        """Delete the tables; what was made from them has to be kept already."""
        jvm = self.spark._jvm
        for table in tables:
            self.drop(self.folders.pop(id(table)))
        gc.collect()
        jvm.System.gc()

    def drop(self, folder: str) -> None:
        """Delete a folder of the shared one."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def settle(self) -> None:
        """After a step that shuffled much: wait until the driver has let go of it. The first round tells the
        JVM what Python gave up, the second one collects it."""
        for _ in range(2):
            gc.collect()
            self.spark._jvm.System.gc()
            time.sleep(0.5)


def pieces(batches, column: str, most: int, offsets_of=None):
    """Arrow batches cut between rows, so that the lists of ``column`` have at most ``most`` items in one; a longer list is alone."""
    import numpy as np

    for batch in batches:
        if not batch.num_rows:
            continue
        values = batch.column(column)
        offsets = offsets_of(values) if offsets_of else np.asarray(values.offsets, dtype=np.int64)
        start = 0
        while start < batch.num_rows:
            end = max(start + 1, int(np.searchsorted(offsets, offsets[start] + most, side="right")) - 1)
            yield batch.slice(start, end - start)
            start = end


def flat(column):
    """Values and offsets of an Arrow list column as numpy arrays."""
    import numpy as np

    offsets = np.asarray(column.offsets, dtype=np.int64)
    return np.asarray(column.flatten(), dtype=np.int64), offsets - offsets[0]


def mixed(a, b):
    """One 64-bit key per pair of 64-bit keys."""
    import numpy as np

    with np.errstate(over="ignore"):
        x = a.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + b.astype(np.uint64)
        x ^= x >> np.uint64(31)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        return x ^ (x >> np.uint64(29))
