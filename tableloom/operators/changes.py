"""Data semantics of changing tables, as functions from tables to tables.

How snapshots are stored is left to the table format that Spark writes to.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableloom.functions.scalar import bind

#: Bits of a Z-order code; the sign bit stays free.
CODE_BITS = 62
#: Bits of a column's cell: 256 cells.
CELL_BITS = 8


def _checked(df: DataFrame, like: DataFrame) -> DataFrame:
    """``df`` with the types of ``like`` where both have a column; a type that could lose values is refused."""
    kinds = dict(like.dtypes)
    wider = {("int", "bigint"), ("smallint", "int"), ("smallint", "bigint"), ("tinyint", "smallint"), ("tinyint", "int"), ("tinyint", "bigint"), ("float", "double"), ("int", "double")}
    for name, kind in df.dtypes:
        if name in kinds and kind not in (kinds[name], "void") and (kind, kinds[name]) not in wider:
            raise ValueError(f"column {name} is {kinds[name]}, not {kind}")
    return df.select(*[F.col(c).cast(kinds[c]).alias(c) if c in kinds else F.col(c) for c in df.columns])


def merged(target: DataFrame, source: DataFrame, key: str, update: Sequence[str] | None = None) -> DataFrame:
    """MERGE: matching rows take all or the chosen columns of ``source``, other source rows are inserted.

    Column ``outcome`` is kept, updated or inserted; its counts are the merge's
    report. One full outer join: each side is shuffled once. Source keys must be
    unique; a NULL key matches nothing. Columns the source lacks are NULL in
    inserted rows.
    """
    source = _checked(source, target)
    update = [c for c in (update or target.columns) if c != key and c in source.columns]
    old = target.select(F.col(key).alias("__k"), F.struct(*target.columns).alias("__old"))
    new = source.select(F.col(key).alias("__n"), F.struct(*source.columns).alias("__new"))
    both = old.join(new, F.col("__k") == F.col("__n"), "full")
    stays, comes = F.col("__old").isNotNull(), F.col("__new").isNotNull()

    def value(c: str) -> Column:
        fresh = F.col(f"__new.{c}") if c in source.columns else F.lit(None).cast(target.schema[c].dataType)
        return F.when(~stays, fresh).when(comes & F.lit(c in update), fresh).otherwise(F.col(f"__old.{c}")).alias(c)

    outcome = F.when(~stays, "inserted").when(comes, "updated").otherwise("kept")
    return both.select(*[value(c) for c in target.columns], outcome.alias("outcome"))


def evolved(table: DataFrame, incoming: DataFrame) -> DataFrame:
    """Append of rows that may have new columns or lack some; missing values are NULL. Types must agree."""
    return table.unionByName(_checked(incoming, table), allowMissingColumns=True)


def changes(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """Rows that differ between two states of a table: insert, update or delete. Deletes carry the old values."""
    cols = [c for c in after.columns if c != key]
    for c in cols:
        if c not in before.columns:
            before = before.withColumn(c, F.lit(None).cast(after.schema[c].dataType))
    a = before.select(F.col(key).alias("__k1"), F.struct(*cols).alias("__old"))
    b = after.select(F.col(key).alias("__k2"), F.struct(*cols).alias("__new"))
    both = a.join(b, F.col("__k1") == F.col("__k2"), "full")
    kind = F.when(F.col("__old").isNull(), "insert").when(F.col("__new").isNull(), "delete").when(
        ~F.col("__old").eqNullSafe(F.col("__new")), "update")
    shown = F.coalesce("__new", "__old")
    return both.withColumn("change", kind).filter(F.col("change").isNotNull()).select(
        F.coalesce("__k2", "__k1").alias(key), "change", *[shown[c].alias(c) for c in cols])


def signed(changed: DataFrame, before: DataFrame, key: str) -> DataFrame:
    """The rows that ``changes`` names as rows that came (``sign`` 1) and went (-1); an update is both."""
    cols = [c for c in changed.columns if c != "change"]
    came = changed.filter("change != 'delete'").select(*cols, F.lit(1).alias("sign"))
    gone = before.join(changed.filter("change != 'insert'").select(key), key, "left_semi")
    return came.unionByName(gone.select(*[c for c in cols if c in before.columns], F.lit(-1).alias("sign")), allowMissingColumns=True)


def rank_cells(df: DataFrame, columns: Sequence[str], bits: int) -> list[Column]:
    """For each numeric column, which of ``2 ** bits`` cells of about equal row counts holds the value; the first for NULL.

    Cells end at quantiles of a sketch, one pass for all columns, so a skewed column fills
    them as evenly as a flat one. A value has one cell, however many rows share it.
    """
    cells = 1 << bits
    shares = [i / cells for i in range(1, cells)]
    ends = df.agg(*[F.percentile_approx(F.col(c).cast("double"), shares, 16 * cells).alias(f"p{j}") for j, c in enumerate(columns)]).first()
    steps = F.array(*[F.lit(1 << b) for b in range(bits - 1, -1, -1)])

    def cell(column: str, points: list[float] | None) -> Column:
        if not points:
            return F.lit(0)
        given = F.struct(F.array(*[F.lit(p) for p in points]).alias("p"), F.col(column).cast("double").alias("v"))
        return bind(given, lambda both: F.aggregate(
            steps, F.lit(0), lambda at, width: F.when(F.get(both["p"], at + width - 1) < both["v"], at + width).otherwise(at)))

    return [cell(c, points) for c, points in zip(columns, ends)]


def z_order(df: DataFrame, columns: Sequence[str]) -> Column:
    """Bits of the numeric columns' cells by rank, interleaved into one number that is never negative."""
    bits = min(CELL_BITS, CODE_BITS // len(columns))
    if bits == 0:
        raise ValueError(f"at most {CODE_BITS} columns")

    def woven(cells: Column) -> Column:
        code = F.lit(0).cast("long")
        for j in range(len(columns)):
            for i in range(bits):
                bit = F.shiftright(cells[f"c{j}"], i).bitwiseAND(F.lit(1)).cast("long")
                code = code.bitwiseOR(F.shiftleft(bit, i * len(columns) + j))
        return code

    return bind(F.struct(*[c.alias(f"c{j}") for j, c in enumerate(rank_cells(df, columns, bits))]), woven)


def clustered(df: DataFrame, columns: Sequence[str], files: int) -> DataFrame:
    """The rows along a Z-order curve in ``files`` ranges, ready to be written.

    Within a code the columns themselves and then a hash decide, so a cell that holds
    a large part of the rows is cut too.
    """
    order = ["__z", *columns, "__h"]
    keyed = df.withColumn("__z", z_order(df, columns)).withColumn("__h", F.xxhash64(*df.columns))
    return keyed.repartitionByRange(files, *order).sortWithinPartitions(*order).drop("__z", "__h")


def file_ranges(stored_rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per file of a stored table: rows, and the least and largest value of each column, as a reader skips files by them."""
    ends = [x for c in columns for x in (F.min(c).alias(f"{c}_min"), F.max(c).alias(f"{c}_max"))]
    return stored_rows.groupBy(F.input_file_name().alias("file")).agg(F.count(F.lit(1)).alias("rows"), *ends)


def share_read(column: str, low, high) -> Column:
    """Share of the files whose range of the column meets ``low`` to ``high``; use in ``ranges.agg``."""
    meets = (F.col(f"{column}_max") >= F.lit(low)) & (F.col(f"{column}_min") <= F.lit(high))
    return F.avg(F.coalesce(meets, F.lit(False)).cast("double"))
