"""Data dictionary: one row per column with its type and completeness.

The source project wrote dictionaries from a declared or inferred schema. Here the
dictionary also says how complete each column is, computed in one distributed pass
(``count(col)`` per column, combined map-side), then turned into rows with ``unpivot``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- fixed values: Spark type -> dictionary type name ----------------------------------
TYPE_NAMES = {
    "string": "STRING",
    "integer": "INTEGER",
    "long": "INTEGER",
    "short": "INTEGER",
    "byte": "INTEGER",
    "double": "FLOAT",
    "float": "FLOAT",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp": "DATE",
    "timestamp_ntz": "DATE",
}
DEFAULT_TYPE_NAME = "STRING"
# ------------------------------------------------------------------------------------


def describe(df: DataFrame, descriptions: dict[str, str] | None = None) -> DataFrame:
    """Rows (posicao, codigo, tipo, descricao, n_linhas, n_preenchidos) for ``df``'s columns.

    A description is taken from ``descriptions``, else from the column's comment in the schema.

    The column metadata frame has one row per column (its size is the schema's, not the
    data's), so joining it costs nothing.
    """
    spark = df.sparkSession
    cols = df.columns
    descriptions = descriptions or {}
    counts = df.agg(
        F.count(F.lit(1)).alias("__rows"),
        *[F.count(F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(cols)],
    )
    long = counts.unpivot(
        ids=["__rows"], values=[f"c{i}" for i in range(len(cols))], variableColumnName="__k", valueColumnName="n_preenchidos"
    )
    meta_schema = T.StructType(
        [
            T.StructField("__k", T.StringType()),
            T.StructField("posicao", T.IntegerType()),
            T.StructField("codigo", T.StringType()),
            T.StructField("tipo", T.StringType()),
            T.StructField("descricao", T.StringType()),
        ]
    )
    meta = spark.createDataFrame(
        [
            (
                f"c{i}",
                i + 1,
                f.name,
                TYPE_NAMES.get(f.dataType.typeName(), DEFAULT_TYPE_NAME),
                descriptions.get(f.name) or (f.metadata or {}).get("comment") or f"Campo {f.name}",
            )
            for i, f in enumerate(df.schema.fields)
        ],
        meta_schema,
    )
    return long.join(meta, "__k").select(
        "posicao", "codigo", "tipo", "descricao", F.col("__rows").alias("n_linhas"), "n_preenchidos"
    )


def profile(df: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, column, type, rows, filled): for each column of ``df`` but the keys, how many rows
    of a key (of a file, say) there are, and how many have a value. One pass, combined
    map-side; counts of several profiles are merged by sum (``from_profile``)."""
    cols = [f for f in df.schema.fields if f.name not in keys]
    counts = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rows"), *[F.count(F.col(f"`{f.name}`")).alias(f"c{i}") for i, f in enumerate(cols)]
    )
    each = [
        F.struct(F.lit(f.name).alias("column"), F.lit(TYPE_NAMES.get(f.dataType.typeName(), DEFAULT_TYPE_NAME)).alias("type"), F.col("rows"), F.col(f"c{i}").alias("filled"))
        for i, f in enumerate(cols)
    ]
    return counts.select(*keys, F.inline(F.array(*each)))


def from_profile(profiles: DataFrame, columns: list[str], descriptions: dict[str, str] | None = None, total: int | None = None) -> DataFrame:
    """The rows of :func:`describe` from merged profiles, which are all that is read.

    ``columns`` gives the order; others come after them by name. Rows of files that lack a
    column count as not filled: ``total`` is the number of all rows.
    A column whose files disagree on its type is text.
    """
    said = descriptions or {}
    sums = profiles.groupBy("column").agg(
        F.sum("rows").alias("own_rows"),
        F.sum("filled").alias("n_preenchidos"),
        F.when(F.min("type") == F.max("type"), F.min("type")).otherwise(F.lit(DEFAULT_TYPE_NAME)).alias("tipo"),
    )
    sums = sums.withColumn("rows", F.col("own_rows") if total is None else F.lit(total).cast("long"))
    place = F.coalesce(*[F.when(F.col("column") == c, F.lit(i)) for i, c in enumerate(columns)], F.lit(len(columns)))
    text = F.coalesce(*[F.when(F.col("column") == c, F.lit(t)) for c, t in said.items()], F.concat(F.lit("Campo "), "column"))
    # a window over one row for each column of the dataset
    ranked = sums.withColumn("posicao", F.row_number().over(Window.orderBy(place, "column")))
    return ranked.select("posicao", F.col("column").alias("codigo"), "tipo", text.alias("descricao"), F.col("rows").alias("n_linhas"), "n_preenchidos")


def as_document(dictionary: DataFrame, title: str) -> DataFrame:
    """One row ``{titulo, campos: [{codigo, tipo, descricao}, ...]}`` in column order,
    ready for ``write.json``. The list holds one entry per column (schema-sized)."""
    entry = F.struct("posicao", "codigo", "tipo", "descricao")
    return dictionary.agg(F.sort_array(F.collect_list(entry)).alias("campos")).select(
        F.lit(title).alias("titulo"),
        F.transform("campos", lambda e: F.struct(e["codigo"].alias("codigo"), e["tipo"].alias("tipo"), e["descricao"].alias("descricao"))).alias("campos"),
    )


def write_document(df: DataFrame, dest: str, title: str, descriptions: dict[str, str] | None = None) -> str:
    """Describe ``df`` and write the ``{titulo, campos}`` document as JSON (one small file)."""
    as_document(describe(df, descriptions), title).write.mode("overwrite").json(dest)
    return dest
