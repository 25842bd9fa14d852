"""What the cells of CSV files say about the types of their columns, folded over all rows and files.

Reads stay declared: nothing here changes how a table is read. The report is for whoever writes the declaration.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evenkeel.sources.tables import read_csv
from evenkeel.spec import FeatureSpec

INTEGER = r"^[+-]?[0-9]+$"
NUMBER = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"
DATE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
TIMESTAMP = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}:[0-9]{2}([.][0-9]+)?$"

#: Kinds of cells that one type holds, the narrowest type first within a family.
FAMILIES = {
    "number": ("int", "bigint", "double"),
    "time": ("date", "timestamp_ntz"),
    "boolean": ("boolean",),
}
MAJORITY = 0.5


def kind_of(cell: Column) -> Column:
    """The narrowest type that holds a cell; null for a null cell. Empty text and cells with blanks around are text."""
    return (
        F.when(cell.isNull(), F.lit(None).cast("string"))
        .when(cell.rlike(INTEGER) & cell.try_cast("int").isNotNull(), "int")
        .when(cell.rlike(INTEGER) & cell.try_cast("bigint").isNotNull(), "bigint")
        .when(cell.rlike(NUMBER), "double")
        .when(F.lower(cell).isin("true", "false"), "boolean")
        .when(cell.rlike(DATE) & cell.try_cast("date").isNotNull(), "date")
        .when(cell.rlike(TIMESTAMP) & cell.try_cast("timestamp_ntz").isNotNull(), "timestamp_ntz")
        .otherwise("string")
    )


def _widest(family: str) -> Column:
    """The narrowest type that holds all cells of a family, by the counts of their kinds."""
    kinds = FAMILIES[family]
    found = F.lit(kinds[0])
    for kind in kinds[1:]:
        found = F.when(F.col(kind) > 0, F.lit(kind)).otherwise(found)
    return found


def _of_family(family: str) -> Column:
    return reduce(lambda a, b: a + b, [F.col(k) for k in FAMILIES[family]])


def column_evidence(
    cells: DataFrame, columns: list[str] | None = None, file: str | Column | None = None, majority: float = MAJORITY
) -> DataFrame:
    """``(column, type, values, nulls, padded, longest, mostly, misfits, misfit_files, example, example_file)`` for the
    text ``columns`` of ``cells``, all by default, in their order.

    ``type`` holds every cell: int, bigint or double for numbers (double where whole numbers exceed bigint), date or
    timestamp_ntz, boolean, else string; string too where there is no value. ``padded`` counts whole numbers with leading
    zeros, which a numeric type would lose, ``longest`` the characters of the longest value.
    A text column of which at least the share ``majority`` of the values, but not all, are of one family is a conflict:
    ``mostly`` is the type of those, ``misfits`` how many values are not, ``misfit_files`` in how many files (if ``file``
    tells a row's), ``example`` the least of them, with the least of its files. Otherwise these are null.

    All columns are counted in one pass, by kind inside each task first; a second pass reads conflicting columns only.
    A table without rows gives a row per column, without values.
    """
    names = columns or cells.columns
    spark = cells.sparkSession
    origin = (F.col(file) if isinstance(file, str) else file) if file is not None else F.lit(None).cast("string")
    long = cells.select(F.posexplode(F.array(*[F.col(f"`{c}`") for c in names])).alias("place", "cell"))
    counts = (
        long.select("place", "cell", kind_of(F.col("cell")).alias("kind"))
        .groupBy("place", "kind")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if(F.col("cell").rlike(r"^[+-]?0[0-9]+$")).alias("padded"),
            F.max(F.length("cell")).alias("longest"),
        )
    )
    kinds = [k for family in FAMILIES.values() for k in family]
    sums = [F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("n"))), F.lit(0)).alias(k) for k in [*kinds, "string"]]
    folded = counts.groupBy("place").agg(
        F.coalesce(F.sum(F.when(F.col("kind").isNotNull(), F.col("n"))), F.lit(0)).alias("values"),
        F.coalesce(F.sum(F.when(F.col("kind").isNull(), F.col("n"))), F.lit(0)).alias("nulls"),
        F.sum("padded").alias("padded"),
        F.max("longest").alias("longest"),
        *sums,
    )
    kind, mostly = F.lit("string"), F.lit(None).cast("string")
    for family in FAMILIES:
        held = _of_family(family)
        kind = F.when((held > 0) & (held == F.col("values")), _widest(family)).otherwise(kind)
        conflict = (held > 0) & (held < F.col("values")) & (held >= F.col("values") * F.lit(majority))
        mostly = F.when(mostly.isNull() & conflict, _widest(family)).otherwise(mostly)
    judged = folded.select(
        "place", kind.alias("type"), "values", "nulls", "padded", "longest", mostly.alias("mostly")
    ).collect()  # one row per column
    schema = "place int, type string, values long, nulls long, padded long, longest int, mostly string"
    places = spark.createDataFrame(list(enumerate(names)), "place int, column string")
    told = places.join(spark.createDataFrame(judged, schema), "place", "left").withColumn(
        "type", F.coalesce("type", F.lit("string"))
    ).fillna(0, ["values", "nulls", "padded"])
    misfits = _misfits(cells, names, {r["place"]: r["mostly"] for r in judged if r["mostly"]}, origin)
    return told.join(misfits, "place", "left").orderBy("place").drop("place")


def _misfits(cells: DataFrame, names: list[str], mostly: dict[int, str], file: Column) -> DataFrame:
    """``(place, misfits, misfit_files, example, example_file)`` for the columns in conflict."""
    if not mostly:
        schema = "place int, misfits long, misfit_files long, example string, example_file string"
        return cells.sparkSession.createDataFrame([], schema)
    entries = [
        F.struct(F.lit(place).alias("place"), F.col(f"`{names[place]}`").alias("cell")) for place in sorted(mostly)
    ]
    long = cells.select(file.alias("file"), F.explode(F.array(*entries)).alias("of")).select("file", "of.*")
    fits = {p: next(kinds for kinds in FAMILIES.values() if kind in kinds) for p, kind in mostly.items()}
    wanted = reduce(
        or_, [(F.col("place") == p) & ~kind_of(F.col("cell")).isin(*kinds) for p, kinds in fits.items()]
    )
    by_file = long.where(F.col("cell").isNotNull() & wanted).groupBy("place", "file").agg(
        F.count(F.lit(1)).alias("n"), F.min("cell").alias("least")
    )
    return by_file.groupBy("place").agg(
        F.sum("n").alias("misfits"),
        F.count("file").alias("misfit_files"),
        F.min(F.struct("least", "file")).alias("first"),
    ).select("place", "misfits", "misfit_files", F.col("first.least").alias("example"), F.col("first.file").alias(
        "example_file"
    ))


def csv_evidence(
    spark: SparkSession, path: str, sep: str = ",", multi_line: bool = False, majority: float = MAJORITY
) -> DataFrame:
    """``column_evidence`` of all CSV files at ``path``. Files whose header differs from the first one's fail the read."""
    cells = read_csv(spark, path, {}, sep=sep, multi_line=multi_line)
    return column_evidence(cells, cells.columns, cells.metadataColumn("_metadata")["file_path"], majority)


def proposed_types(evidence: DataFrame) -> dict[str, T.DataType]:
    """Types to declare for ``read_csv``; columns with a conflict stay text."""
    return {
        r["column"]: T.StructType.fromDDL(f"c {r['type']}")["c"].dataType
        for r in evidence.select("column", "type").collect()
    }


def against_spec(evidence: DataFrame, spec: FeatureSpec) -> DataFrame:
    """The evidence with ``declared``, the type that ``spec`` reads the column with (null if it has no role), and
    ``fits``: whether every value can be read so. Columns with a role that no file has come last, with no values and a
    null ``type``."""
    holds = {"int": ("int",), "bigint": FAMILIES["number"][:2], "double": FAMILIES["number"]}
    declared = [(name, kind.simpleString()) for name, kind in spec.types().items()]
    roles = evidence.sparkSession.createDataFrame(declared, "column string, declared string")
    fits = F.col("declared").isNull() | (F.col("declared") == "string") | (F.col("values") == 0)
    for kind, held in holds.items():
        fits = fits | ((F.col("declared") == kind) & F.col("type").isin(*held))
    fits = fits | (F.col("declared") == F.col("type"))
    numbered = evidence.withColumn("_at", F.row_number().over(Window.orderBy(F.monotonically_increasing_id())))
    joined = numbered.join(roles, "column", "full")  # a row per column
    judged = joined.withColumn("fits", F.coalesce(fits, F.lit(False)))
    return judged.orderBy(F.col("_at").asc_nulls_last(), "column").drop("_at")
