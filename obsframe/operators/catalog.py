"""The book catalogue and the rule table: validation, lookups and change batches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsframe import fixed
from obsframe.functions.scalars import json_value, status_to_db
from obsframe.operators.ordered import even_chunks, join_per_chunk, range_rank

_ACCEPTED = 200
_MALFORMED = 400
_UNPROCESSABLE = 422


def _type_of(variant: Column, path: str) -> Column:
    return F.coalesce(F.schema_of_variant(F.try_variant_get(variant, path, "variant")), F.lit(""))


def _book_class(variant: Column) -> Column:
    """Class of one parsed book input; types are strict."""
    texts = (_type_of(variant, "$.title") == "STRING") & (_type_of(variant, "$.author") == "STRING")
    kind = _type_of(variant, "$.status")
    status = status_to_db(F.try_variant_get(variant, "$.status", "string"))
    status_ok = kind.isin("", "VOID") | ((kind == "STRING") & status.isNotNull())
    return F.when(texts & status_ok, _ACCEPTED).otherwise(_UNPROCESSABLE)


def _book_fields(variant: Column, accepted: Column) -> list[Column]:
    text = lambda name: F.when(accepted, F.try_variant_get(variant, f"$.{name}", "string"))
    status = F.coalesce(
        status_to_db(F.try_variant_get(variant, "$.status", "string")), F.lit(fixed.DEFAULT_STATUS)
    )
    return [text("title").alias("title"), text("author").alias("author"), F.when(accepted, status).alias("status")]


def validate_books(raw: DataFrame, body: str = "body", keep: Sequence[str] = ()) -> DataFrame:
    """Class of each JSON body with the fields of the accepted ones.

    400 malformed, 422 missing or mistyped field or unknown status, 200 accepted.
    """
    doc = json_value(body)
    code = F.when(F.col("_doc").isNull(), _MALFORMED).otherwise(_book_class(F.col("_doc")))
    parsed = raw.withColumn("_doc", doc).withColumn("code", code)
    return parsed.select(*keep, "code", *_book_fields(F.col("_doc"), F.col("code") == _ACCEPTED))


def validate_book_lists(raw: DataFrame, body: str = "body", keep: Sequence[str] = ()) -> DataFrame:
    """Bulk form: one row per body with its class and the array of accepted books.

    The body must be an array; one bad element rejects all; ``[]`` is accepted.
    """
    doc = F.col("_doc")
    is_list = F.coalesce(F.schema_of_variant(doc).startswith("ARRAY"), F.lit(False))
    items = F.coalesce(
        F.try_variant_get(doc, "$", "array<variant>"), F.array().cast("array<variant>")
    )
    all_good = F.forall(items, lambda v: _book_class(v) == _ACCEPTED)
    code = (
        F.when(doc.isNull(), _MALFORMED)
        .when(is_list & all_good, _ACCEPTED)
        .otherwise(_UNPROCESSABLE)
    )
    books = F.transform(items, lambda v: F.struct(*_book_fields(v, F.lit(True))))
    return (
        raw.withColumn("_doc", json_value(body))
        .withColumn("code", code)
        .select(*keep, "code", F.when(F.col("code") == _ACCEPTED, books).alias("books"))
    )


def check_configs(configs: DataFrame) -> DataFrame:
    """Every row with the names of the table constraints it breaks."""
    rules: list[tuple[str, Column]] = [
        (f"{c} is null", F.col(c).isNull())
        for c in ("endpoint_pattern", "http_method", "error_rate", "error_code")
    ]
    rules.append(("error_rate out of range", ~F.col("error_rate").between(0.0, 1.0)))
    rules.append(("error_code out of range", ~F.col("error_code").between(400, 599)))
    # Rows without a full pair repeat nothing and stay out of the join.
    has_pair = F.col("endpoint_pattern").isNotNull() & F.col("http_method").isNotNull()
    paired, rest = configs.filter(has_pair), configs.filter(~has_pair)
    repeated = (
        paired.groupBy("endpoint_pattern", "http_method").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    )
    joined = paired.join(repeated, ["endpoint_pattern", "http_method"], "left").unionByName(
        rest.withColumn("_n", F.lit(None).cast("bigint"))
    )
    rules.append(("endpoint_pattern, http_method not unique", F.col("_n").isNotNull()))
    violations = F.array_compact(F.array(*[F.when(broken, F.lit(name)) for name, broken in rules]))
    return joined.withColumn("violations", violations).select(*configs.columns, "violations")


def get_books(books: DataFrame, ids: DataFrame | Sequence[int]) -> DataFrame:
    """Books of the given ids; a missing id gives no row."""
    if isinstance(ids, DataFrame):
        return books.join(ids.select("id"), "id", "left_semi")
    return books.filter(F.col("id").isin(list(ids)))


def configs_for(configs: DataFrame, method: str | None = None, limit: int | None = None) -> DataFrame:
    """Rules in id order, of one method or of all; the first ``limit`` if given."""
    chosen = configs if method is None else configs.filter(F.col("http_method") == method)
    ordered = chosen.orderBy("id")
    return ordered if limit is None else ordered.limit(limit)


def enrich_books(books: DataFrame, details: DataFrame) -> DataFrame:
    """Left join of details by id; ``enriched`` tells whether there was one."""
    renamed = details.select(
        F.col("id"), *[F.col(c).alias(f"detail_{c}") for c in details.columns if c != "id"],
        F.lit(True).alias("enriched"),
    )
    return books.join(renamed, "id", "left").withColumn(
        "enriched", F.coalesce("enriched", F.lit(False))
    )


def list_books(books: DataFrame) -> DataFrame:
    return books.orderBy("title", "author", "id")


def first_books(books: DataFrame, n: int = 5) -> DataFrame:
    return list_books(books).limit(n)


def apply_changes(
    table: DataFrame,
    changes: DataFrame,
    force_status: str | None = None,
    pieces: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Apply an ordered batch of insert, update and delete rows to a keyed table.

    ``changes`` has a unique BIGINT ``seq``, ``op``, ``id`` and the new values.
    Inserts get the ids after the largest one, by ``seq``.  A change reaches an id
    that was there before it and is not deleted yet; otherwise it affects 0 rows.
    Returns the new table and the report (seq, op, id, rows_affected).

    The numbers of ``seq`` may be sparse or crowded: inserts are ranked by sampled ranges
    and written once, and the edits of a busy id are met in ``pieces`` even stretches.

    Per id only aggregates are needed: the first delete, and the last update of ids
    that survive.  They are combined on the map side before anything is joined by id.
    """
    values, id_type = ["title", "author", "status"], table.schema["id"].dataType
    default = F.lit(fixed.DEFAULT_STATUS)
    status = F.col("status") if "status" in changes.columns else F.lit(None).cast("string")
    if force_status is not None:
        status = F.when(F.col("op") == "update", F.lit(force_status)).otherwise(status)
    changes = changes.select("seq", "op", F.col("id").cast("bigint"), "title", "author", status.alias("status"))

    top = table.select(F.coalesce(F.max("id"), F.lit(0)).cast("bigint").alias("top")).scalar()
    inserted = range_rank(changes.filter("op = 'insert'"), [F.asc("seq")], "_rank", "inserts").select(
        (F.col("_rank") + top).alias("id"),
        F.col("seq").alias("birth"),
        "title",
        "author",
        F.coalesce("status", default).alias("status"),
    )
    standing = table.select(
        F.col("id").cast("bigint"), F.lit(None).cast("bigint").alias("birth"), *values
    )
    entities = standing.unionByName(inserted)
    births = entities.select(F.col("id").alias("e_id"), "birth")
    edits = changes.filter("op in ('update', 'delete')")

    # Ids of the table take every change to them.  Ids of this batch take the changes
    # after their birth, met per stretch of seq so that one busy id is many tasks.
    old = edits.filter(F.col("id") <= top)
    new = join_per_chunk(
        edits.filter(F.col("id") > top), ["id"], even_chunks(edits, "seq", pieces)("seq"),
        inserted.select("id", "birth"),
    ).filter(F.col("seq") > F.col("birth")).drop("birth")
    fate = old.unionByName(new).groupBy(F.col("id").alias("f_id")).agg(
        F.min(F.when(F.col("op") == "delete", F.col("seq"))).alias("deleted_at"),
        F.max_by(
            F.struct("title", "author", "status"), F.when(F.col("op") == "update", F.col("seq"))
        ).alias("update"),
    )
    after = entities.join(fate, entities["id"] == fate["f_id"], "left").filter("deleted_at is null")
    result = after.select(
        F.col("id").cast(id_type).alias("id"),
        *[
            F.when(F.col("update").isNotNull(), F.coalesce(F.col(f"update.{c}"), F.col(c)))
            .otherwise(F.col(c))
            .alias(c)
            for c in values
        ],
    )
    known = births.join(fate.drop("update"), births["e_id"] == fate["f_id"], "left").drop("f_id")
    edit_report = edits.join(known, edits["id"] == known["e_id"], "left").select(
        "seq",
        "op",
        "id",
        F.when(
            F.col("e_id").isNotNull()
            & (F.col("birth").isNull() | (F.col("seq") > F.col("birth")))
            & (F.col("deleted_at").isNull() | (F.col("seq") <= F.col("deleted_at"))),
            1,
        ).otherwise(0).alias("rows_affected"),
    )
    insert_report = inserted.select(
        F.col("birth").alias("seq"), F.lit("insert").alias("op"), "id", F.lit(1).alias("rows_affected")
    )
    return result, insert_report.unionByName(edit_report)


def bulk_insert(table: DataFrame, rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Insert many rows at once; returns the new table and the new ids by ``seq``.

    Rows without a status become available; no rows give no ids.
    """
    changes = rows.withColumn("op", F.lit("insert")).withColumn("id", F.lit(None).cast("bigint"))
    result, report = apply_changes(table, changes)
    return result, report.select("seq", F.col("id").cast(table.schema["id"].dataType).alias("id"))
