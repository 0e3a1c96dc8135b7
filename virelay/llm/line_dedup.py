"""Line deduplication over levelled sorted runs of line hashes.

A batch of documents becomes a run: its line keys' hashes, bucketed and sorted,
each with the number of the batch's documents that hold it.  A new batch is
merge-anti-joined with the runs of settled keys (those at the threshold already,
which need no more counting) and adds what is left as a run of its own.  When a
level holds ``FANOUT`` runs they are merged: keys that reach the threshold go to
a run of settled keys, the others to one run of the next level.  Runs are tables
with a fixed number of buckets, each one sorted file, so that neither the joins
nor the merges exchange or sort them again.  Only DataFrame functions are used.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ascii_lower, column, drop_stored, setting, shared_dir, stored

FANOUT = 4
#: Batches that a table is cut into.
BATCHES = 5
#: The most frequent settled keys, whose lines are dealt to several tasks each, and of how many tasks a key of all documents is.
HOT, SALTS = 4096, 1024
#: What is stripped from both ends of a line to make its key.
BLANKS = " \t\n\x0b\x0c\r"
#: Lets Spark rely on the order of a bucket's only file.
ORDERED = "spark.sql.legacy.bucketedTableScan.outputOrdering"


def line_key(line: Column) -> Column:
    """The line without blanks at both ends, A-Z in lower case.

    ``lower`` does the same as the slower ``translate`` where all is ASCII.
    """
    core = F.btrim(line, F.lit(BLANKS))
    return F.when(F.octet_length(core) == F.char_length(core), F.lower(core)).otherwise(ascii_lower(core))


def lines_of(text: Column) -> Column:
    """The lines of a text; null or empty: one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def hashes(key: Column) -> list[Column]:
    """128 bits in two columns; keys with equal hashes count as equal."""
    return [F.xxhash64(key).alias("h1"), F.xxhash64(F.lit("line"), key).alias("h2")]


def line_counts(documents: DataFrame, text_col: str, batch: Column | None = None) -> DataFrame:
    """h1, h2, n_docs of the line keys of a table, every row of which is one document; with ``batch``, for each of its values."""
    keys = documents.select(*([] if batch is None else [batch.alias("batch")]), F.explode(F.array_distinct(F.transform(lines_of(column(text_col)), line_key))).alias("key")).filter("key <> ''")
    by = ([] if batch is None else ["batch"]) + ["h1", "h2"]
    return keys.select(*by[:-2], *hashes(F.col("key"))).groupBy(*by).agg(F.count(F.lit(1)).alias("n_docs"))


class LineRuns:
    """The levelled runs and the settled ones, as bucketed and sorted tables in the shared folder.

    A level is one table to which each run adds a sorted file for each bucket, so
    that a bucket's runs meet in one task.  ``min_docs`` is the number of
    documents at which a key is settled.
    """

    def __init__(self, spark: SparkSession, min_docs: int, fanout: int = FANOUT, buckets: int | None = None):
        self.spark, self.min_docs, self.fanout = spark, min_docs, fanout
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.root, self.name = shared_dir(spark, "line-runs"), f"virelay_line_run_{uuid.uuid4().hex}"
        #: Each level's table, and how many runs it holds.
        self.levels: list[tuple[str, int]] = []
        self.done: list[str] = []
        self._made = 0

    def _new(self) -> str:
        self._made += 1
        return f"{self.name}_{self._made}"

    def _write(self, rows: DataFrame, name: str) -> str:
        """Adds rows, which lie in the buckets' tasks already, as one sorted file for each bucket."""
        rows.write.mode("append").bucketBy(self.buckets, "h1", "h2").sortBy("h1", "h2").option("path", f"{self.root}/{name}").saveAsTable(name)
        return name

    def _drop(self, *names: str) -> None:
        for name in names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
            drop_stored(self.spark, f"{self.root}/{name}")

    def _add(self, rows: DataFrame, level: int) -> None:
        if level == len(self.levels):
            self.levels.append((self._new(), 0))
        name, runs = self.levels[level]
        self.levels[level] = self._write(rows, name), runs + 1

    def merged(self, name: str) -> DataFrame:
        """A table's keys with the sums of all its runs; the buckets' runs meet where they are."""
        return self.spark.table(name).groupBy("h1", "h2").agg(F.sum("n_docs").alias("n_docs"))

    def unsettled(self, counts: DataFrame) -> DataFrame:
        """A batch's counts, dealt to the buckets, without the settled keys, by a merge-anti-join with each settled run."""
        fresh = counts.repartition(self.buckets, "h1", "h2")
        for name in self.done:
            fresh = fresh.join(self.spark.table(name).select("h1", "h2").hint("merge"), ["h1", "h2"], "left_anti")
        return fresh

    def add_documents(self, documents: DataFrame, text_col: str) -> None:
        """Adds a batch of documents, every row being one."""
        counts = stored(line_counts(documents, text_col), "line-counts")
        self.add(counts)
        drop_stored(self.spark, counts.stored_at)

    def add(self, counts: DataFrame) -> None:
        """Adds a batch's :func:`line_counts` as a run, and merges levels that are full.

        They are a stored table: otherwise Spark would join the lines before it counts them.
        """
        with setting(self.spark, ORDERED, "true"):
            self._add(self.unsettled(counts), 0)
            level = 0
            while level < len(self.levels) and self.levels[level][1] >= self.fanout:
                name, sums = self.levels[level][0], self.merged(self.levels[level][0])
                self.done.append(self._write(sums.filter(F.col("n_docs") >= self.min_docs), self._new()))
                self._add(sums.filter(F.col("n_docs") < self.min_docs), level + 1)
                self.levels[level] = self._new(), 0
                self._drop(name)
                level += 1
            if len(self.done) >= self.fanout:
                old, every = self.done, self._new()
                for name in old:
                    self._write(self.spark.table(name), every)
                self.done = [self._write(self.merged(every), self._new())]
                self._drop(every, *old)

    def settled(self) -> DataFrame:
        """h1, h2 and n_docs (what has been counted) of the keys that at least ``min_docs`` documents hold, as a stored table; the runs go."""
        names = [*self.done, *(name for name, runs in self.levels if runs)]
        every = self._new()
        for name in names:
            self._write(self.spark.table(name), every)
        sums = self.merged(every) if names else self.spark.createDataFrame([], "h1 long, h2 long, n_docs long")
        out = stored(sums.filter(F.col("n_docs") >= self.min_docs), "settled-lines")
        self._drop(every, *names)
        drop_stored(self.spark, self.root)
        return out


def drop_frequent_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = 10, batches: int = BATCHES) -> DataFrame:
    """Drops, in every document, the lines whose key at least ``min_docs`` documents hold.

    Returns ``row`` (struct of all of ``df``'s columns), ``n_lines`` (before),
    ``n_dropped`` and ``kept`` (the other lines, joined by a newline), a row for
    each row of ``df``.  The rows are dealt to ``batches`` batches by a hash of
    their id, which become runs one after another; the table is read once for
    the lines of all batches, and once more to cut it.

    Null or empty text is one empty line, which is never dropped; keys differ
    from lines only as :func:`line_key` says.  Each row counts as a document,
    repeated rows and ids and null ids included.  All columns of ``df`` travel
    inside ``row``, so no name can clash.  An empty table gives no row.
    """
    spark = df.sparkSession
    runs = LineRuns(spark, min_docs)
    batch = F.pmod(F.xxhash64(column(id_col).cast("string")), F.lit(batches)).cast("int")
    counts = stored(line_counts(df, text_col, batch), "line-counts")
    for k in range(batches):
        runs.add(counts.filter(F.col("batch") == k).select("h1", "h2", "n_docs"))
    drop_stored(spark, counts.stored_at)
    settled = runs.settled()

    # A few keys may have very many lines: these are dealt to as many tasks as they need, and their settled rows repeated.
    total = settled.agg(F.sum("n_docs")).first()[0] or 1
    salts = F.least(F.lit(SALTS), F.ceil(F.col("n_docs") * SALTS / F.lit(total))).cast("int")
    hot = settled.orderBy(F.desc("n_docs"), "h1", "h2").limit(HOT).select("h1", "h2", salts.alias("salts")).filter("salts > 1")
    hot = stored(hot, "hot-lines")  # at most HOT rows

    row, text = F.col("row"), F.coalesce(F.col("row").getField(text_col), F.lit(""))
    # A row is known by its id and 128 bits of its text: rows alike in these are cut alike.
    known = [row.getField(id_col).alias("id"), F.xxhash64(text).alias("t1"), F.xxhash64(F.lit("text"), text).alias("t2")]
    rows = df.select(F.struct(*[column(c) for c in df.columns]).alias("row"))
    lines = rows.select(*known, F.posexplode(F.transform(lines_of(text), line_key)).alias("pos", "key"))
    lines = lines.filter("key <> ''").select("id", "t1", "t2", "pos", *hashes(F.col("key")))
    lines = lines.join(F.broadcast(hot), ["h1", "h2"], "left").withColumn("salt", F.when(F.col("salts").isNull(), 0).otherwise(F.pmod(F.xxhash64("t1", "pos"), F.col("salts"))).cast("int"))
    each = settled.join(F.broadcast(hot), ["h1", "h2"], "left").select("h1", "h2", F.explode(F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1)).alias("salt"))
    gone = lines.join(each, ["h1", "h2", "salt"]).groupBy("id", "t1", "t2").agg(F.sort_array(F.collect_set("pos")).alias("gone"))

    keyed = rows.select(*known, "row")
    on = keyed["id"].eqNullSafe(gone["id"]) & (keyed["t1"] == gone["t1"]) & (keyed["t2"] == gone["t2"])
    both = keyed.join(gone, on, "left").select("row", F.coalesce("gone", F.array().cast("array<int>")).alias("gone"))
    # The lines between one dropped line and the next are sliced out whole, in time linear in the lines.
    both = both.withColumn("lines", lines_of(row.getField(text_col))).withColumn("edges", F.concat(F.array(F.lit(-1)), "gone", F.array(F.size("lines"))))
    spans = F.zip_with(F.slice("edges", 1, F.size("gone") + 1), F.slice("edges", 2, F.size("gone") + 1), lambda a, b: F.slice(F.col("lines"), a + 2, b - a - 1))
    return both.select(
        "row", F.size("lines").cast("long").alias("n_lines"), F.size("gone").cast("long").alias("n_dropped"),
        F.when(F.size("gone") == 0, F.coalesce(row.getField(text_col), F.lit(""))).otherwise(F.array_join(F.flatten(spans), "\n")).alias("kept"),
    )
