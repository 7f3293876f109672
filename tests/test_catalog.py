import random

import pytest
from pyspark.sql import functions as F

from obsframe import schemas
from obsframe.operators import catalog as C
from obsframe.plans.session import fresh_dir
from obsframe.sources import read_table

CHANGES = "seq bigint, op string, id bigint, title string, author string, status string"


def books(spark, *rows):
    return spark.createDataFrame(list(rows), schemas.BOOKS)


def bodies(spark, *texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "n int, body string")


@pytest.mark.parametrize("body, code, book", [
    ('{"author":"Ines Aldana","title":"Salt and Signal"}', 200, ("Salt and Signal", "Ines Aldana", "available")),
    ('{"author":"a","title":"t","status":"Lost","extra":{"x":1}}', 200, ("t", "a", "lost")),
    ('{"author":"a","title":"t","status":null}', 200, ("t", "a", "available")),
    ('{"title": "Half a', 400, None),
    ('{"title": bare, "author": words}', 400, None),
    ("", 400, None),
    ('{"author":"a","title":"t"} trailing', 400, None),
    ('{"author":"Nobody Wrote"}', 422, None),
    ('{"author":1,"title":"t"}', 422, None),
    ('{"author":"a","title":null}', 422, None),
    ('{"author":"a","title":"t","status":"mislaid"}', 422, None),
    ('{"author":"a","title":"t","status":"lost"}', 422, None),
    ('{"author":"a","title":"t","status":1}', 422, None),
    ("[]", 422, None),
    ('"text"', 422, None),
])
def test_validate_books(spark, body, code, book):
    r = C.validate_books(bodies(spark, body)).first()
    assert r.code == code
    assert (r.title, r.author, r.status) == (book or (None, None, None))


@pytest.mark.parametrize("body, code, titles", [
    ('[{"author":"M. Orr","title":"Low Tide"},{"author":"K. Vale","title":"High Water"}]', 200, ["Low Tide", "High Water"]),
    ("[]", 200, []),
    ("neither list nor book", 400, None),
    ('{"author":"a","title":"t"}', 422, None),
    ('[{"author":"a","title":"t"},{"author":"a"}]', 422, None),
    ("[1]", 422, None),
    ("[null]", 422, None),
])
def test_validate_book_lists(spark, body, code, titles):
    r = C.validate_book_lists(bodies(spark, body)).first()
    assert r.code == code and (r.books and [b.title for b in r.books]) == (titles or (None if titles is None else []))


def test_check_configs(spark):
    rows = [
        (1, "/a", "GET", 0.5, 500, None, None),
        (2, "/a", "GET", 1.5, 399, None, None),
        (3, None, "GET", None, 600, None, None),
        (4, None, "GET", 0.0, 400, None, None),
        (5, "/a", "POST", float("nan"), None, None, None),
    ]
    got = {r.id: r.violations for r in C.check_configs(spark.createDataFrame(rows, schemas.CONFIGS)).collect()}
    unique = "endpoint_pattern, http_method not unique"
    assert got == {
        1: [unique], 2: ["error_rate out of range", "error_code out of range", unique],
        3: ["endpoint_pattern is null", "error_rate is null", "error_code out of range"],
        4: ["endpoint_pattern is null"], 5: ["error_code is null", "error_rate out of range"],
    }


def simulate(table, changes, force=None):
    state = {i: [t, a, s] for i, t, a, s in table}
    top, report = max(state, default=0), []
    for seq, op, id_, title, author, status in sorted(changes):
        if op == "insert":
            top += 1
            state[top] = [title, author, status or "available"]
            report.append((seq, op, top, 1))
        elif id_ not in state:
            report.append((seq, op, id_, 0))
        elif op == "delete":
            del state[id_]
            report.append((seq, op, id_, 1))
        else:
            state[id_] = [title, author, force or status or state[id_][2]]
            report.append((seq, op, id_, 1))
    return sorted((i, *v) for i, v in state.items()), sorted(report)


def applied(spark, table, changes, **kw):
    result, report = C.apply_changes(books(spark, *table), spark.createDataFrame(changes, CHANGES), **kw)
    return sorted(map(tuple, result.collect())), sorted(tuple(r) for r in report.collect())


@pytest.mark.parametrize("seed", range(4))
def test_change_batches_equal_a_sequential_run(spark, seed):
    rng = random.Random(seed)
    table = [(i, f"t{i}", f"a{i}", "borrowed") for i in rng.sample(range(1, 30), 12)]
    changes = []
    for seq in rng.sample(range(-500, 500), 120):
        op = rng.choice(["insert", "update", "update", "delete"])
        id_ = None if op == "insert" else rng.choice([3, 3, 3] + list(range(1, 70)))
        status = None if op == "insert" and rng.random() < 0.5 else rng.choice(["available", "lost"])
        changes.append((seq, op, id_, f"T{seq}", f"A{seq}", status))
    assert applied(spark, table, changes, pieces=7) == simulate(table, changes)


def test_forced_status(spark):
    table, changes = [(1, "t", "a", "lost")], [(1, "update", 1, "t2", "a2", "borrowed")]
    assert applied(spark, table, changes, force_status="available") == simulate(table, changes, "available")


# -- the request scenarios on the catalogue, as batches ------------------------

SEED = [(i, f"Title {i}", f"Author {i}", "available") for i in range(1, 93)]


def test_list_and_get(spark):
    df = books(spark, *SEED)
    assert C.list_books(df).count() == 92
    titles = [r.title for r in C.list_books(df).collect()]
    assert titles == sorted(titles)
    assert [r.title for r in C.first_books(df).collect()] == sorted(titles)[:5]
    assert [r.title for r in C.get_books(df, [7]).collect()] == ["Title 7"]
    assert C.get_books(df, [99999]).count() == 0
    assert C.get_books(df, spark.createDataFrame([(7,), (7,), (500,)], "id int")).count() == 1


def test_update_existing_and_missing(spark):
    table, report = applied(spark, SEED, [(1, "update", 5, "Revised", "Lea Finch", None), (2, "update", 99999, "x", "y", None)])
    assert report == [(1, "update", 5, 1), (2, "update", 99999, 0)]
    assert (5, "Revised", "Lea Finch", "available") in table and len(table) == 92


def test_create_then_get(spark):
    accepted = C.validate_books(bodies(spark, '{"author":"Ines Aldana","title":"Salt and Signal"}'), keep=["n"]).filter("code = 200")
    result, ids = C.bulk_insert(books(spark, *SEED), accepted.withColumn("seq", F.col("n").cast("bigint")))
    new_id = ids.first().id
    assert tuple(C.get_books(result, [new_id]).first()) == (93, "Salt and Signal", "Ines Aldana", "available")


def test_bulk_create(spark):
    body = '[{"author":"M. Orr","title":"Low Tide"},{"author":"K. Vale","title":"High Water"}]'
    rows = C.validate_book_lists(bodies(spark, body)).select(F.posexplode("books").alias("seq", "b")).select(
        F.col("seq").cast("bigint").alias("seq"), "b.*")
    result, ids = C.bulk_insert(books(spark, *SEED), rows)
    assert [tuple(r) for r in ids.orderBy("seq").collect()] == [(0, 93), (1, 94)]
    assert {r.title for r in C.get_books(result, [93, 94]).collect()} == {"Low Tide", "High Water"}


def test_bulk_create_of_nothing(spark):
    empty = spark.createDataFrame([], "seq bigint, title string, author string, status string")
    result, ids = C.bulk_insert(books(spark, *SEED), empty)
    assert ids.count() == 0 and result.count() == 92
    result, ids = C.bulk_insert(books(spark), spark.createDataFrame([(1, "t", "a", None)], empty.schema))
    assert [r.id for r in ids.collect()] == [1] and result.count() == 1


def test_delete_existing_and_missing(spark):
    table, report = applied(spark, SEED, [(1, "delete", 5, None, None, None), (2, "delete", 99999, None, None, None)])
    assert [r[3] for r in report] == [1, 0] and len(table) == 91 and 5 not in [r[0] for r in table]


def test_enrichment_keeps_misses(spark):
    details = spark.createDataFrame([(1, "x")], "id int, note string")
    got = C.enrich_books(books(spark, *SEED[:2]), details).orderBy("id").collect()
    assert [(r.id, r.detail_note, r.enriched) for r in got] == [(1, "x", True), (2, None, False)]


def test_configs_for(spark):
    rows = [(i, f"/p{i}", "GET" if i % 2 else "PUT", 0.1, 500, None, None) for i in range(1500, 0, -1)]
    df = spark.createDataFrame(rows, schemas.CONFIGS)
    got = [r.id for r in C.configs_for(df, "GET", 100).collect()]
    assert got == list(range(1, 200, 2)) and C.configs_for(df, limit=1000).count() == 1000 and C.configs_for(df).count() == df.count()


def test_read_table(spark):
    path = fresh_dir(spark, "t")
    books(spark, *SEED).withColumn("unused", F.lit(1)).write.parquet(path)
    df = read_table(spark, "books", path=path)
    assert df.columns == ["id", "title", "author", "status"] and df.count() == 92
