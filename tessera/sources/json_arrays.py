"""Large JSON array files read by many tasks.

A file that holds one array has no line ends to split at, and a ``}`` or ``,`` in the
middle of it may be text. It is read as pieces that end after a ``}``, which Spark's text
source splits over tasks like lines. What a piece does to the parser's state is known
without the state: its quotes flip or keep "inside a string", and there are two depth
changes, one for either start. These effects combine in any grouping (a monoid), so

1. running sums inside each chunk of a file (at most ``CHUNK`` pieces that follow each other
   in one split) give every piece's effect up to there,
2. running sums over the chunks' totals (one row per chunk) give each chunk's start,
3. both together tell the pieces that end an element of the array.

Escapes never reach over a piece's end: a backslash before the ``}`` escapes just that.
Text moves once, to the chunk's task; only elements that reach over a chunk's end move
a second time. Chunks are dealt over as many tasks as the files' size asks for, so a task
sorts about ``TASK_BYTES`` of text whatever the size of a split or the number of shuffle
partitions. All steps are column expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

CLOSE = "}"
#: Pieces of one chunk (a power of two), and text of one task.
CHUNK, TASK_BYTES = 1 << 15, 32 << 20
KEYS = ("file", "block", "chunk")


def pieces(spark: SparkSession, path) -> DataFrame:
    """``(file, block, chunk, line, size, value)``: the text up to each ``}`` (left out), in file
    order by block, chunk and line; ``size`` is the file's length in bytes."""
    text = spark.read.option("lineSep", CLOSE).text(path if isinstance(path, str) else list(path))
    text = text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                       F.monotonically_increasing_id().alias("line"), F.col("_metadata.file_size").alias("size"), "value")
    chunk = F.shiftright("line", CHUNK.bit_length() - 1).alias("chunk")
    return text.select("file", "block", chunk, "line", "size", "value")


def _tasks(spark: SparkSession, path) -> int:
    """The number of tasks that hold ``TASK_BYTES`` of the files each (a listing; no file is opened)."""
    size = spark.read.format("binaryFile").load(path if isinstance(path, str) else list(path)).agg(F.sum("length")).first()[0]
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), (size or 0) // TASK_BYTES)


def _depth_change(text: Column) -> Column:
    """Brackets opened less brackets closed in a text that starts outside a string."""
    bare = F.regexp_replace(text, r'"[^"]*("|\z)', "")
    return F.length(F.translate(bare, "]}", "")) - F.length(F.translate(bare, "[{", ""))


def effects(df: DataFrame) -> DataFrame:
    """Add what each piece and its ``}`` do: ``flip`` (1: a string begins or ends over it),
    and the change of depth if it starts outside (``out``) or inside (``in``) a string."""
    plain = F.regexp_replace("value", r"(?s)\\.", "")
    flip = F.pmod(F.length(plain) - F.length(F.translate(plain, '"', "")), F.lit(2))
    return (df.withColumn("flip", flip)
            .withColumn("out", _depth_change(plain) - F.when(F.col("flip") == 0, 1).otherwise(0))
            .withColumn("in", _depth_change(F.concat(F.lit('"'), plain)) - F.when(F.col("flip") == 1, 1).otherwise(0)))


def _upto(*keys: str, order: str):
    return Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def running(df: DataFrame) -> DataFrame:
    """``flips`` and, for a chunk that starts outside or inside a string, the depth changes
    ``d_out`` and ``d_in`` from the chunk's start up to and with each piece."""
    w = _upto(*KEYS, order="line")
    df = df.withColumn("flips", F.sum("flip").over(w))
    even = (F.col("flips") - F.col("flip")) % 2 == 0  # the piece starts as the chunk does
    return (df.withColumn("d_out", F.sum(F.when(even, F.col("out")).otherwise(F.col("in"))).over(w))
            .withColumn("d_in", F.sum(F.when(even, F.col("in")).otherwise(F.col("out"))).over(w)))


def chunk_starts(df: DataFrame, tasks: int) -> DataFrame:
    """One row per chunk: whether it starts ``inside`` a string, at which ``depth`` (null in a
    file that is no array), whether it is the file's last and whether that ends with ``}``."""
    blank = F.regexp_replace("value", r"\s", "") == ""
    each = effects(df.withColumn("first", F.when((F.col("block") == 0) & ~blank, F.substring(F.ltrim("value"), 1, 1)))
                   .withColumn("bytes", F.octet_length("value") + 1)).drop("value")  # the text stays
    each = running(each.repartition(tasks, *KEYS)).groupBy(*KEYS).agg(
        F.sum("flip").alias("flip"), F.max_by("d_out", "line").alias("out"), F.max_by("d_in", "line").alias("in"),
        F.min_by("first", "line").alias("first"), F.sum("bytes").alias("bytes"), F.max("size").alias("size"))
    each = each.withColumn("place", F.struct("block", "chunk"))
    upto, whole = _upto("file", order="place"), Window.partitionBy("file")
    each = each.withColumn("flips", F.sum("flip").over(upto))
    change = F.when((F.col("flips") - F.col("flip")) % 2 == 0, F.col("out")).otherwise(F.col("in"))
    each = each.withColumn("inside", (F.col("flips") - F.col("flip")) % 2).withColumn("change", change)
    return each.select(
        *KEYS, "inside",
        F.when(F.min_by("first", "place").over(whole) == "[", F.sum("change").over(upto) - F.col("change")).alias("depth"),
        (F.max("place").over(whole) == F.col("place")).alias("last"),
        (F.sum("bytes").over(whole) == F.max("size").over(whole)).alias("closed"))


def elements(spark: SparkSession, path) -> DataFrame:
    """The array elements of the files, one row each: ``(at, pos, text)``; ``at`` (file, block,
    line) and ``pos`` order them as the files do.

    Equal to parsing each file whole, but for a broken array: its well-formed elements
    before the fault are read. A file that is no array is parsed whole, by one task. A
    single element is always text of one task.
    """
    df, tasks = pieces(spark, path), _tasks(spark, path)
    start = chunk_starts(df, tasks).toDF("f", "b", "c", "inside", "depth", "last", "closed")
    rows = running(effects(df).repartition(tasks, *KEYS)).join(
        start, (F.col("file") == F.col("f")) & (F.col("block") == F.col("b")) & (F.col("chunk") == F.col("c")))
    depth = F.col("depth") + F.when(F.col("inside") == 0, F.col("d_out")).otherwise(F.col("d_in"))
    ends = ((F.col("inside") + F.col("flips")) % 2 == 0) & (depth == 1)
    by_line = Window.partitionBy(*KEYS).orderBy("line")
    final = F.col("last") & F.lead("line").over(by_line).isNull()  # after it the file ends
    rows = (rows.withColumn("ends", F.coalesce(ends, F.lit(False)) & ~final)
            .withColumn("text", F.when(final & ~F.col("closed"), F.col("value")).otherwise(F.concat("value", F.lit(CLOSE))))
            .withColumn("n", F.sum(F.col("ends").cast("long")).over(_upto(*KEYS, order="line"))
                        - F.col("ends").cast("long")))
    parts = rows.groupBy(*KEYS, "n").agg(
        F.min("line").alias("line"), F.max("ends").alias("ends"), _joined("line", "text").alias("text"))
    whole = parts.where("n > 0 and ends").select("file", "block", "line", "text", F.lit(False).alias("first"),
                                                 F.lit(False).alias("rest"))
    # a chunk's first and last parts may belong together with those of the chunks beside it
    open_ = parts.where("n = 0 or not ends").withColumn("order", F.struct("block", "chunk", "n"))
    ended = F.col("ends").cast("long")
    open_ = open_.withColumn("k", F.sum(ended).over(_upto("file", order="order")) - ended)
    over = open_.groupBy("file", "k").agg(
        F.min(F.struct("block", "line")).alias("at"), _joined("order", "text").alias("text"), F.max("ends").alias("ends"))
    over = over.select("file", "at.block", "at.line", "text", (F.col("k") == 0).alias("first"), (~F.col("ends")).alias("rest"))
    return _parsed(whole.unionByName(over))


def _joined(order: str, text: str) -> Column:
    return F.array_join(F.sort_array(F.collect_list(F.struct(order, text)))[text], "")


def _parsed(rows: DataFrame) -> DataFrame:
    """Texts between two element ends: the array's opening bracket or a comma, any plain
    values, and an object; at the file's end the closing bracket."""
    array = ~F.col("first") | F.ltrim("text").startswith("[")
    body = F.regexp_replace("text", F.when(F.col("first"), F.lit(r"\A\s*\[")).otherwise(F.lit(r"\A\s*,")), "")
    body = F.when(F.col("rest"), F.regexp_replace(body, r"\]\s*\z", "")).otherwise(body)
    text = F.when(array, F.concat(F.lit("["), body, F.lit("]"))).otherwise(F.col("text"))
    blank = array & (F.regexp_replace(body, r"\s", "") == "")
    return (rows.where(~blank).select(F.struct("file", "block", "line").alias("at"), text.alias("text"))
            .select("at", F.posexplode(F.from_json("text", "array<string>")).alias("pos", "text")))
