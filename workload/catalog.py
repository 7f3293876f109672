"""Catalogue, rule table, routes and change batches."""

from pyspark.sql import functions as F

from obsframe import fixed
from obsframe.operators import catalog as C
from obsframe.operators import routes as RT
from workload.registry import query
from workload.views import sql_of, table, view, with_views

_V = with_views

_BODY = """CASE p_partkey % 9
  WHEN 0 THEN '{"author":"' || p_brand || '","title":"' || p_name || '"}'
  WHEN 1 THEN '{"author":"' || p_brand || '","title":"' || p_name || '","status":"Lost","pages":3}'
  WHEN 2 THEN '{"invalid json'
  WHEN 3 THEN '{"invalid": json}'
  WHEN 4 THEN '{"author":"' || p_brand || '"}'
  WHEN 5 THEN '{"author":' || CAST(p_partkey AS STRING) || ',"title":"' || p_name || '"}'
  WHEN 6 THEN '{"author":"a","title":"t","status":"unknown"}'
  WHEN 7 THEN '{"author":"a","title":"t","status":null}'
  ELSE '"text"' END"""


@query("p16_validate_books", """
  SELECT p_partkey, CASE WHEN p_partkey % 9 IN (2, 3) THEN 400 WHEN p_partkey % 9 IN (0, 1, 7) THEN 200 ELSE 422 END AS code,
    CASE p_partkey % 9 WHEN 0 THEN p_name WHEN 1 THEN p_name WHEN 7 THEN 't' END AS title,
    CASE p_partkey % 9 WHEN 0 THEN p_brand WHEN 1 THEN p_brand WHEN 7 THEN 'a' END AS author,
    CASE p_partkey % 9 WHEN 0 THEN 'available' WHEN 1 THEN 'lost' WHEN 7 THEN 'available' END AS status
  FROM part""")
def validate_books(spark, sf):
    raw = table(spark, sf, "part").select("p_partkey", F.expr(_BODY).alias("body"))
    return C.validate_books(raw, keep=["p_partkey"])


@query("p16_validate_book_lists", """
  SELECT p_partkey, CASE p_partkey % 5 WHEN 3 THEN 400 WHEN 2 THEN 422 WHEN 4 THEN 422 ELSE 200 END AS code,
    CASE p_partkey % 5 WHEN 0 THEN 2 WHEN 1 THEN 0 END AS n_books,
    CASE p_partkey % 5 WHEN 0 THEN p_name || '|' || 't2' WHEN 1 THEN '' END AS titles FROM part""")
def validate_book_lists(spark, sf):
    raw = table(spark, sf, "part").select("p_partkey", F.expr("""CASE p_partkey % 5
      WHEN 0 THEN '[{"author":"a","title":"' || p_name || '"},{"author":"b","title":"t2","status":"Borrowed"}]'
      WHEN 1 THEN '[]' WHEN 2 THEN '[{"author":"a","title":"t"},{"author":"b"}]'
      WHEN 3 THEN 'not an array' ELSE '{"author":"a","title":"t"}' END""").alias("body"))
    out = C.validate_book_lists(raw, keep=["p_partkey"])
    return out.select("p_partkey", "code", F.size("books").alias("n_books"),
                      F.array_join(F.transform("books", lambda b: b["title"]), "|").alias("titles"))


@query("p17_check_configs", _V(["rules"], """
  SELECT r.id, concat_ws('; ',
    CASE WHEN r.endpoint_pattern IS NULL THEN 'endpoint_pattern is null' END,
    CASE WHEN r.error_rate IS NULL THEN 'error_rate is null' END,
    CASE WHEN r.error_rate < 0 OR r.error_rate > 1 THEN 'error_rate out of range' END,
    CASE WHEN r.error_code < 400 OR r.error_code > 599 THEN 'error_code out of range' END,
    CASE WHEN r.endpoint_pattern IS NOT NULL AND count(*) OVER (PARTITION BY r.endpoint_pattern, r.http_method) > 1
      THEN 'endpoint_pattern, http_method not unique' END) AS violations FROM rules r"""))
def check_configs(spark, sf):
    return C.check_configs(view(spark, sf, "rules")).select("id", F.array_join("violations", "; ").alias("violations"))


@query("p21_get_books", _V(["books"], """
  SELECT id, title, author, status FROM books WHERE id IN (SELECT o_custkey * 3 FROM orders)"""))
def get_books(spark, sf):
    ids = table(spark, sf, "orders").select((F.col("o_custkey") * 3).alias("id"))
    return C.get_books(view(spark, sf, "books"), ids).select("id", "title", "author", "status")


_RULE_COLS = "id, endpoint_pattern, http_method, error_rate, error_code, error_message"


@query("p22_configs_for", _V(["rules"], f"""
  SELECT 'GET' AS asked, * FROM (SELECT {_RULE_COLS} FROM rules WHERE http_method = 'GET' ORDER BY id LIMIT 100)
  UNION ALL
  SELECT 'all' AS asked, * FROM (SELECT {_RULE_COLS} FROM rules ORDER BY id LIMIT 1000)"""))
def configs_for(spark, sf):
    rules = view(spark, sf, "rules")
    one = C.configs_for(rules, "GET", fixed.RULES_PER_METHOD).withColumn("asked", F.lit("GET"))
    return one.unionByName(C.configs_for(rules, limit=fixed.RULES_TOTAL).withColumn("asked", F.lit("all")))


@query("j1_enrich_books", _V(["books"], """
  SELECT b.id, b.title, d.author AS detail_author, d.id IS NOT NULL AS enriched
  FROM books b LEFT JOIN (SELECT id * 2 AS id, author FROM books) d ON b.id = d.id"""))
def enrich_books(spark, sf):
    books = view(spark, sf, "books")
    details = books.select((F.col("id") * 2).alias("id"), "author")
    return C.enrich_books(books, details).select("id", "title", "detail_author", "enriched")


_WINNER = """CASE
    WHEN method = 'GET' AND path = '/books' THEN 4 WHEN method = 'GET' AND path = '/books/add' THEN 3
    WHEN method = 'GET' AND regexp_full_match(path, '/books/[^/]+') THEN 1
    WHEN method = 'POST' AND path = '/books/add' THEN 2
    WHEN method = 'DELETE' AND regexp_full_match(path, '/.+') THEN 5 END"""


@query("j2_match_routes", _V(["requests"], f"SELECT request_id, CAST({_WINNER} AS BIGINT) AS rule_id FROM requests"))
def match_routes(spark, sf):
    out = RT.match_routes(view(spark, sf, "requests"), view(spark, sf, "configs"), per_method=fixed.RULES_PER_METHOD)
    return out.select("request_id", F.col("rule.id").alias("rule_id"))


_TABLE = {
    "id": "o_orderkey",
    "http_method": "'M' || CAST(o_custkey % 50 AS STRING)",
    "endpoint_pattern": (
        "CASE o_orderkey % 8 WHEN 0 THEN '/books/' || CAST(o_custkey % 40 AS STRING) WHEN 1 THEN '/books/{id}' "
        "WHEN 2 THEN '/books/{id}/pages/{page}' WHEN 3 THEN '/books/' || CAST(o_custkey % 40 AS STRING) || '/pages/{page}' "
        "WHEN 4 THEN '/{area}/' || CAST(o_custkey % 7 AS STRING) WHEN 5 THEN '/files/{*rest}' WHEN 6 THEN '/files/{name}' "
        "ELSE CASE WHEN o_orderkey % 96 = 7 THEN '/{*all}' END END"
    ),
}
_ASKED = {
    "request_id": "event_id",
    "method": "'M' || CAST(event_id % 50 AS STRING)",
    "path": (
        "CASE event_id % 6 WHEN 0 THEN '/books/' || CAST(user_id % 60 AS STRING) "
        "WHEN 1 THEN '/books/' || CAST(user_id % 60 AS STRING) || '/pages/' || CAST(user_id % 3 AS STRING) "
        "WHEN 2 THEN '/files/a' WHEN 3 THEN '/files/a/' || CAST(user_id % 5 AS STRING) "
        "WHEN 4 THEN '/area/' || CAST(user_id % 9 AS STRING) ELSE '/' END"
    ),
}
_columns = lambda columns: ", ".join(f"{e} AS {c}" for c, e in columns.items())
_DIGITS = "CASE WHEN s LIKE '{*%}' THEN '2' WHEN s LIKE '{%}' THEN '1' ELSE '0' END"


@query("j2_match_rule_table", with_views([], """
  SELECT a.request_id, w.rule_id FROM asked a LEFT JOIN w USING (method, path)""",
    rules=f"SELECT {_columns(_TABLE)} FROM orders",
    asked=f"SELECT {_columns(_ASKED)} FROM events",
    parsed=f"""SELECT id, http_method AS method, list_transform(string_split(endpoint_pattern, '/'), lambda s: {_DIGITS}) AS kinds,
      list_transform(string_split(endpoint_pattern, '/'), lambda s: CASE WHEN s LIKE '{{%}}' THEN '' ELSE s END) AS texts
      FROM rules WHERE endpoint_pattern IS NOT NULL""",
    leaves="SELECT method, kinds, texts, min(id) AS id FROM parsed GROUP BY ALL",
    nodes="""SELECT method, id, kinds[i] AS kind, kinds[1:i - 1] AS above, texts[1:i - 1] AS words FROM
      (SELECT *, unnest(range(1, len(kinds) + 1)) AS i FROM leaves) WHERE kinds[i] <> '0'""",
    claims="SELECT method, above, words, arg_min(kind, id) AS claim FROM nodes GROUP BY ALL",
    kept="""SELECT * FROM leaves WHERE id NOT IN
      (SELECT id FROM nodes JOIN claims USING (method, above, words) WHERE kind <> claim)""",
    paths="SELECT DISTINCT method, path, string_split(path, '/') AS parts FROM asked",
    met="""SELECT p.method, path, array_to_string(kinds, '') AS place, id FROM paths p JOIN kept k ON p.method = k.method
      AND (len(parts) = len(kinds) OR (kinds[-1] = '2' AND len(parts) > len(kinds)))
      WHERE list_bool_and(list_transform(range(1, len(kinds) + 1), lambda i: CASE kinds[i] WHEN '0' THEN parts[i] = texts[i]
        WHEN '1' THEN parts[i] <> '' ELSE len(parts) > len(kinds) OR parts[i] <> '' END))""",
    w="SELECT method, path, arg_min(id, place) AS rule_id FROM met GROUP BY ALL"))
def match_rule_table(spark, sf):
    """Rules of 50 methods from a table, among them parameters and rests at the same place."""
    some = {"error_rate": "0.5D", "error_code": "500", "error_message": "'m'"}
    pick = lambda name, columns: table(spark, sf, name).select(
        *[F.expr(e).alias(c) for c, e in columns.items()])
    out = RT.match_routes(pick("events", _ASKED), pick("orders", _TABLE | some))
    return out.select("request_id", F.col("rule.id").alias("rule_id"))


@query("j3_inject_errors", _V(["requests", "configs"], """
  SELECT w.request_id, coalesce(draw < c.error_rate, false) AS injected,
    CASE WHEN draw < c.error_rate THEN c.error_code END AS status,
    CASE WHEN draw < c.error_rate THEN coalesce(c.error_message, CASE c.error_code WHEN 503 THEN 'Service Unavailable'
      WHEN 418 THEN 'I''m a teapot' ELSE 'Injected Error' END) END AS body
  FROM w LEFT JOIN configs c ON c.id = w.rule_id""",
    w=f"""SELECT request_id, CAST({_WINNER} AS INT) AS rule_id,
      CAST('0x' || substr(md5('42:' || CAST(request_id AS VARCHAR)), 1, 8) AS BIGINT) / 4294967296.0::DOUBLE AS draw
      FROM requests"""))
def inject_errors(spark, sf):
    out = RT.inject_errors(view(spark, sf, "requests"), view(spark, sf, "configs"), seed=42,
                           per_method=fixed.RULES_PER_METHOD)
    return out.select("request_id", "injected", "status", "body")


_CHANGED = dict(
    ins="""SELECT seq AS birth, (SELECT max(id) FROM books) + row_number() OVER (ORDER BY seq) AS id, title, author,
             'available' AS status FROM changes WHERE op = 'insert'""",
    ent="SELECT id, -1 AS birth, title, author, status FROM books UNION ALL SELECT id, birth, title, author, status FROM ins",
    del_="""SELECT c.id, min(c.seq) AS gone FROM changes c JOIN ent e ON e.id = c.id AND c.seq > e.birth
            WHERE c.op = 'delete' GROUP BY c.id""",
    hit="""SELECT c.*, row_number() OVER (PARTITION BY c.id ORDER BY c.seq DESC) AS rn FROM changes c
           JOIN ent e ON e.id = c.id AND c.seq > e.birth WHERE c.op = 'update'""",
)


@query("j9_apply_changes", _V(["books", "changes"], """
  SELECT CAST(e.id AS BIGINT) AS id, coalesce(h.title, e.title) AS title, coalesce(h.author, e.author) AS author, e.status
  FROM ent e LEFT JOIN hit h ON h.id = e.id AND h.rn = 1 WHERE e.id NOT IN (SELECT id FROM del_)""", **_CHANGED))
def apply_changes(spark, sf):
    return C.apply_changes(view(spark, sf, "books"), view(spark, sf, "changes"))[0]


#: Half of the numbers are microseconds, far apart; the others are crowded at the start.
_SPARSE = "CASE WHEN {n} % 2 = 0 THEN 1700000000000000 + {n} * CAST(1000003 AS BIGINT) ELSE {n} END"
_LATER = f"SELECT * REPLACE ({_SPARSE.format(n='seq')} AS seq) FROM ({sql_of('changes')})"


@query("j9_apply_sparse_changes", _V(["books"], """
  SELECT CAST(e.id AS BIGINT) AS id, coalesce(h.title, e.title) AS title, coalesce(h.author, e.author) AS author, e.status
  FROM ent e LEFT JOIN hit h ON h.id = e.id AND h.rn = 1 WHERE e.id NOT IN (SELECT id FROM del_)""", changes=_LATER, **_CHANGED))
def apply_sparse_changes(spark, sf):
    changes = view(spark, sf, "changes").withColumn("seq", F.expr(_SPARSE.format(n="seq")))
    return C.apply_changes(view(spark, sf, "books"), changes)[0]


@query("j9_change_report", _V(["books", "changes"], """
  SELECT birth AS seq, 'insert' AS op, CAST(id AS BIGINT) AS id, 1 AS rows_affected FROM ins
  UNION ALL
  SELECT c.seq, c.op, c.id, CASE WHEN e.id IS NOT NULL AND c.seq > e.birth AND (d.gone IS NULL OR c.seq <= d.gone)
    THEN 1 ELSE 0 END AS rows_affected
  FROM changes c LEFT JOIN ent e ON e.id = c.id LEFT JOIN del_ d ON d.id = c.id WHERE c.op <> 'insert'""", **_CHANGED))
def change_report(spark, sf):
    return C.apply_changes(view(spark, sf, "books"), view(spark, sf, "changes"))[1]


@query("j10_bulk_insert", _V(["books"], """
  SELECT id, title, author, status FROM books UNION ALL
  SELECT CAST((SELECT max(id) FROM books) + row_number() OVER (ORDER BY o_orderkey) AS BIGINT), 'T' || CAST(o_orderkey AS VARCHAR),
    o_orderpriority, CASE WHEN o_orderkey % 2 = 0 THEN 'lost' ELSE 'available' END FROM orders"""))
def bulk_insert(spark, sf):
    rows = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("seq"), F.concat(F.lit("T"), F.col("o_orderkey").cast("string")).alias("title"),
        F.col("o_orderpriority").alias("author"), F.expr("CASE WHEN o_orderkey % 2 = 0 THEN 'lost' END AS status"))
    return C.bulk_insert(view(spark, sf, "books"), rows)[0]


@query("l1_list_books", _V(["books"], "SELECT id, title, author, status FROM books ORDER BY title, author, id"))
def list_books(spark, sf):
    return C.list_books(view(spark, sf, "books"))


@query("l2_first_books", _V(["books"], "SELECT id, title, author, status FROM books ORDER BY title, author, id LIMIT 5"))
def first_books(spark, sf):
    return C.first_books(view(spark, sf, "books"))
