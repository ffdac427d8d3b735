"""Paged JSON documents shaped ``[page_meta, records | null]``.

Each document is one row (``wholetext`` read per file, or a text column). Documents that
are not arrays, have fewer than two members, or carry a null record list contribute no
rows. Each record becomes one row; the requested fields are nested paths read as text
(numbers keep their source text), missing objects give null.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def record_schema(fields: Mapping[str, str]) -> T.StructType:
    """Nested struct type with a string leaf for every dotted path."""
    tree: dict = {}
    for path in fields.values():
        node = tree
        parts = path.split(".")
        for p in parts[:-1]:
            node = node.setdefault(p, {})
            if node is None:
                raise ValueError(f"path {path} nests under a leaf")
        node.setdefault(parts[-1], None)

    def build(node: dict) -> T.StructType:
        return T.StructType([T.StructField(k, T.StringType() if v is None else build(v)) for k, v in node.items()])

    return build(tree)


def flatten_paged_json(docs: DataFrame, fields: Mapping[str, str], doc_col: str = "value",
                       keep: tuple = ()) -> DataFrame:
    """``fields`` maps output column -> dotted JSON path inside a record.

    Each record list is parsed once into an array of nested structs (string leaves keep a
    number's source text); a missing object yields null for every path below it.
    """
    schema = T.ArrayType(record_schema(fields))
    records = F.from_json(F.get_json_object(F.col(doc_col), "$[1]"), schema)
    exploded = docs.select(*keep, F.explode(records).alias("_rec"))
    return exploded.select(*keep, *[F.col("_rec." + ".".join(f"`{p}`" for p in path.split("."))).alias(c)
                                    for c, path in fields.items()])


def read_paged_json(spark: SparkSession, path: str, fields: Mapping[str, str], large: bool = False) -> DataFrame:
    """The records of one document a file. A ``large`` document is cut into records by many tasks
    (:mod:`quarry.sources.json_ranges`); else each is one row, read by one task."""
    if large:
        from quarry.sources.json_ranges import read_paged_ranges
        return read_paged_ranges(spark, path, fields)
    return flatten_paged_json(spark.read.text(path, wholetext=True), fields)


def page_summary(docs: DataFrame, doc_col: str = "value", request: Column | None = None) -> DataFrame:
    """Per request: documents, error envelopes, declared page count and distinct pages seen.

    ``request`` tells which documents answer the same request (null is one more request); pages are counted
    within each, so that page 2 of one cannot stand for a missing page 2 of another. Without it all
    documents belong to one request, and the result is one row without a ``request`` column.
    The page metadata is parsed once per document into a struct.
    """
    meta = F.from_json(F.get_json_object(F.col(doc_col), "$[0]"),
                       "page string, pages string, message string")
    is_error = (meta.isNull() | meta["message"].isNotNull()
                | F.get_json_object(F.col(doc_col), "$.message").isNotNull())
    keys = [request.alias("request")] if request is not None else []
    return docs.select(*keys, meta.alias("_m"), is_error.alias("_err")).groupBy(*["request"][:len(keys)]).agg(
        F.count(F.lit(1)).alias("documents"),
        F.count_if("_err").alias("error_documents"),
        F.max(F.col("_m.pages").try_cast("long")).alias("declared_pages"),
        F.count_distinct(F.col("_m.page")).alias("pages_seen"),
    )


def assert_complete_pages(docs: DataFrame, doc_col: str = "value", request: Column | None = None) -> dict:
    """Fail when any response is an error envelope or pages of a request are missing; else the totals."""
    rows = page_summary(docs, doc_col, request)
    complete = F.col("declared_pages").isNull() | (F.col("declared_pages") == F.col("pages_seen"))
    names = F.slice(F.sort_array(F.collect_list(F.when(~complete, F.concat_ws(
        " ", F.coalesce(F.col("request").cast("string"), F.lit("(none)")) if request is not None else F.lit("all"),
        F.concat("pages_seen", F.lit(" of "), "declared_pages"))))), 1, 10)
    row = rows.agg(F.coalesce(F.sum("documents"), F.lit(0)).alias("documents"),
                   F.coalesce(F.sum("error_documents"), F.lit(0)).alias("error_documents"),
                   F.sum("declared_pages").alias("declared_pages"), F.coalesce(F.sum("pages_seen"), F.lit(0)).alias("pages_seen"),
                   F.count_if(~complete).alias("incomplete"), names.alias("missing")).first()
    if row["error_documents"]:
        raise ValueError(f"{row['error_documents']} error response(s) among {row['documents']}")
    if row["incomplete"]:
        raise ValueError(f"pages are missing of {row['incomplete']} request(s), such as {list(row['missing'])}")
    return {k: row[k] for k in ("documents", "error_documents", "declared_pages", "pages_seen")}
