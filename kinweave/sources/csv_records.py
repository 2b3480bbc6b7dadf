"""CSV records whose quoted fields hold line breaks, read from splits of a file.

Files are read as lines, in splits of any size.  A line says what it makes of a quote that is open before it: it opens
one, closes one, leaves it as it is, or both.  Most lines with quotes decide by themselves whether one is open after them,
whatever was before; so the state at every line follows from the last such line, and that at a split from
a small table of one row per split.  Lines of one record then meet by the line it starts on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kinweave.session import cut

#: A quote that is open for more lines than this was never meant to be: each line is a record of its own.
MOST_LINES = 10_000

# What stands in a quoted field: other characters, a doubled quote, or a quote that ends no field.
_INSIDE = '(?:[^"]++|""|"(?!"|,|$))*+'
_WHOLE = f'(^|,)"{_INSIDE}"(?=,|$)'
_CLOSES = f'^{_INSIDE}"(?=,|$)'


def opens(rest: Column) -> Column:
    """Whether a quote is open after text that begins outside of one."""
    return F.regexp_replace(rest, _WHOLE, "$1").rlike('(^|,)"')


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, block, id, value, from_closed, from_open): lines, ids rising within a split, and whether a quote is
    open after the line if none was before it, and if one was."""
    rows = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("id"))
    quoted = F.col("value").contains('"')
    closes = F.col("value").rlike(_CLOSES)
    after = F.regexp_replace("value", _CLOSES, "")
    return rows.select(
        "file", "block", "id", "value", (quoted & opens(F.col("value"))).alias("from_closed"),
        F.when(quoted & closes, opens(after)).otherwise(F.lit(True)).alias("from_open"),
    )


def csv_records(spark: SparkSession, path: str | list[str], header: bool = True, most_lines: int = MOST_LINES) -> DataFrame:
    """(value): the records of the files as text, line breaks inside being `\\n`, without headers and blank records.

    A file without an open quote at any line's end is passed on line by line.  In others only the lines of a record
    meet, never those of a split in one row.  Runs jobs.
    """
    lines = cut(_lines(spark, path), "csv_lines")
    first = lines.groupBy("file").agg(F.min(F.struct("block", "id")).alias("first")).select("file", F.col("first.id").alias("head"))
    broken = cut(lines.where("from_closed").select("file").distinct(), "csv_broken")
    plain = lines.join(broken, "file", "left_anti").select("file", F.col("id").alias("record"), "value")
    if broken.isEmpty():
        records = plain
    else:
        records = plain.unionByName(_joined(cut(_states(lines.join(broken, "file", "left_semi")), "csv_starts"), most_lines))
    if header:
        # The value itself depends on the join, so that nothing a caller asks of it is asked of a header.
        heads = first.select("file", F.col("head").alias("record"), F.lit(True).alias("is_head"))
        records = records.join(heads, ["file", "record"], "left").select(F.when(F.col("is_head").isNull(), F.col("value")).alias("value"))
    return records.select("value").where(F.trim("value") != "")


def _states(lines: DataFrame) -> DataFrame:
    """`lines` with `record`: the id of the line on which the record starts."""
    within = Window.partitionBy("file", "block").orderBy("id")
    before = within.rowsBetween(Window.unboundedPreceding, -1)
    # A line that turns the state round counts for parity; one that sets it is remembered with the parity there.
    turns = (F.col("from_closed") & ~F.col("from_open")).cast("int")
    sets = F.col("from_closed") == F.col("from_open")
    marked = lines.withColumn("turned", F.sum(turns).over(within))
    mark = F.when(sets, F.struct(F.col("from_closed").cast("int").alias("open"), F.col("turned")))
    marked = marked.withColumn("mark", mark).withColumn("last_mark", F.last("mark", True).over(before))
    marked = marked.withColumn("turned_before", F.coalesce(F.max("turned").over(before), F.lit(0)))
    settled = (F.col("last_mark.open") + F.col("turned_before") - F.col("last_mark.turned")) % 2
    # Before the first mark of a split, the state there is that at its start, turned round as often.
    marked = marked.select("file", "block", "id", "value", "from_closed", "from_open", settled.alias("settled"), (F.col("turned_before") % 2).alias("turned"))

    last = F.max_by(F.struct("settled", "turned", "from_closed", "from_open"), "id").alias("last")
    starts = [F.max(F.when(F.coalesce("settled", (F.lit(s) + F.col("turned")) % 2) == 0, F.col("id"))).alias(f"start{s}") for s in (0, 1)]
    splits = marked.groupBy("file", "block").agg(last, *starts)

    def after(s: int) -> Column:
        """The state after a split that begins in state `s`."""
        state = F.coalesce("last.settled", (F.lit(s) + F.col("last.turned")) % 2)
        return F.when(state == 0, F.col("last.from_closed")).otherwise(F.col("last.from_open")).cast("int")

    order = Window.partitionBy("file").orderBy("block")
    splits = splits.withColumns({"after0": after(0), "after1": after(1)})
    # The state at a split's start, by the same rule over whole splits: one row each.
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    turns = ((F.col("after0") == 1) & (F.col("after1") == 0)).cast("int")
    splits = splits.withColumn("turned", F.sum(turns).over(order))
    mark = F.when(F.col("after0") == F.col("after1"), F.struct(F.col("after0").alias("open"), F.col("turned")))
    splits = splits.withColumn("mark", F.last(mark, True).over(earlier)).withColumn("turned", F.coalesce(F.max("turned").over(earlier), F.lit(0)))
    begins = (F.coalesce("mark.open", F.lit(0)) + F.col("turned") - F.coalesce("mark.turned", F.lit(0))) % 2
    splits = splits.withColumn("begins", begins).withColumn("start", F.when(F.col("begins") == 0, F.col("start0")).otherwise(F.col("start1")))
    carried = F.last("start", True).over(earlier)
    splits = cut(splits.withColumn("carried", carried).select("file", "block", "begins", "carried"), "csv_splits")

    known = marked.join(splits, ["file", "block"])
    is_open = F.coalesce("settled", (F.col("begins") + F.col("turned")) % 2)
    start = F.last(F.when(is_open == 0, F.col("id")), True).over(within)
    return known.select("file", "id", "value", F.coalesce(start, "carried").alias("record"))


def _joined(lines: DataFrame, most_lines: int) -> DataFrame:
    """Lines of a record as one text; of one that never ends, each line by itself."""
    counts = lines.groupBy("file", "record").agg(F.count(F.lit(1)).alias("n"))
    endless = cut(counts.where(F.col("n") > most_lines).select("file", "record", F.lit(True).alias("endless")), "csv_endless")
    marked = lines.join(endless, ["file", "record"], "left")
    marked = marked.withColumn("record", F.when(F.col("endless"), F.col("id")).otherwise(F.col("record")))
    text = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("id", "value"))), lambda x: x["value"]), "\n")
    return marked.groupBy("file", "record").agg(text.alias("value"))
