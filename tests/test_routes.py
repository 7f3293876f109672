import random

import pytest

from obsframe.operators import routes as RT

CONFIGS = "id int, endpoint_pattern string, http_method string, error_rate double, error_code int, error_message string"


def configs(spark, *rows):
    return spark.createDataFrame([(i, p, m, r, c, t) for i, p, m, r, c, t in rows], CONFIGS)


def winner(spark, patterns, path):
    rules = configs(spark, *[(i, p, "GET", 1.0, 500, None) for i, p in enumerate(patterns, 1)])
    requests = spark.createDataFrame([(1, "GET", path)], "request_id int, method string, path string")
    rule = RT.match_routes(requests, rules).first().rule
    return rule and rule.endpoint_pattern


@pytest.mark.parametrize("patterns, path, want", [
    (["/books/{id}"], "/books/7", "/books/{id}"),
    (["/books/{id}"], "/books/", None),
    (["/books/{id}"], "/books/7/", None),
    (["/books/{id}"], "/books/7/x", None),
    (["/books/{id}", "/books/add"], "/books/add", "/books/add"),
    (["/a/{x}/c", "/a/b/{y}"], "/a/b/c", "/a/b/{y}"),
    (["/a/b/{y}/z", "/a/{x}/c"], "/a/b/c", "/a/{x}/c"),
    (["/{*rest}", "/a/b"], "/a/b", "/a/b"),
    (["/{*rest}"], "/a/b/c", "/{*rest}"),
    (["/{*rest}"], "/", None),
    (["/{id}", "/{name}"], "/x", "/{id}"),
    (["/a/{x}/{y}", "/a/{*p}"], "/a/b/c/d", None),
    (["/a/{*p}", "/a/{x}"], "/a/b", "/a/{*p}"),
    (["/v1.0/x"], "/v1a0/x", None),
    (["/v1.0/{x}"], "/v1a0/y", None),
    (["/v1.0/{x}"], "/v1.0/y", "/v1.0/{x}"),
    (["books"], "books", None),
    (["/{*rest}/x"], "/a/x", None),
    (["/{id}"], "/a\nb", "/{id}"),
])
def test_matching(spark, patterns, path, want):
    assert winner(spark, patterns, path) == want


def test_methods_do_not_mix_and_no_rules(spark):
    requests = spark.createDataFrame([(1, "GET", "/x"), (2, "POST", "/x")], "request_id int, method string, path string")
    rules = configs(spark, (1, "/x", "POST", 1.0, 503, None))
    assert [r.rule and r.rule.id for r in RT.match_routes(requests, rules).orderBy("request_id").collect()] == [None, 1]
    assert RT.match_routes(requests, rules.limit(0)).filter("rule is not null").count() == 0


def test_all_rules_count_unless_a_limit_is_given(spark):
    rules = configs(spark, *[(i, f"/p{i}", "GET", 1.0, 500, None) for i in range(1, 151)],
                    *[(1000 + i, f"/q{i}", "PUT", 1.0, 500, None) for i in range(3)])
    requests = spark.createDataFrame(
        [("GET", "/p100"), ("GET", "/p101"), ("PUT", "/q2")], "method string, path string")
    assert [r.rule and r.rule.id for r in RT.match_routes(requests, rules).collect()] == [100, 101, 1002]
    limited = RT.match_routes(requests, rules, per_method=100)
    assert [r.rule and r.rule.id for r in limited.collect()] == [100, None, 1002]


def test_injection(spark):
    rules = configs(
        spark, (1, "/a", "GET", 1.0, 500, "custom"), (2, "/b", "GET", 1.0, 418, None),
        (3, "/c", "GET", 1.0, 599, None), (4, "/d", "GET", 0.0, 500, "never"))
    requests = spark.createDataFrame(
        [(i, "GET", p) for i, p in enumerate(["/a", "/b", "/c", "/d", "/e"])], "request_id int, method string, path string")
    got = [(r.injected, r.status, r.body) for r in RT.inject_errors(requests, rules).orderBy("request_id").collect()]
    assert got == [(True, 500, "custom"), (True, 418, "I'm a teapot"), (True, 599, "Injected Error"),
                   (False, None, None), (False, None, None)]


def test_injection_rate_is_met_and_repeatable(spark):
    rules = configs(spark, (1, "/a", "GET", 0.25, 500, None))
    requests = spark.range(20000).selectExpr("id as request_id", "'GET' as method", "'/a' as path")
    hit = RT.inject_errors(requests, rules, seed=1).filter("injected").select("request_id")
    assert abs(hit.count() / 20000 - 0.25) < 0.02
    assert hit.exceptAll(RT.inject_errors(requests.repartition(5), rules, seed=1).filter("injected").select("request_id")).count() == 0


def test_route_template(spark):
    df = spark.createDataFrame([("/books",), ("/books/7",), ("/books/add",), ("/x",)], "path string")
    got = df.select(RT.route_template("path", ["/books/{id}", "/books", "/books/add"])).collect()
    assert [r[0] for r in got] == ["/books", "/books/{id}", "/books/add", None]


# -- a table of rules ------------------------------------------------------------


def by_program(rules, method, path):
    """Admit rules one by one, in the order of their ids; then the first match by rank."""
    kept = []
    for i, pattern in sorted((i, p) for i, p, m in rules if m == method and p is not None):
        route = RT.Route.parse(pattern)
        if route.is_valid and not any(route.conflicts_with(other) for _, other in kept):
            kept.append((i, route))
    best = None
    for i, route in kept:
        parts = path.split("/")
        rest = route.kinds[-1] == "2"
        if len(parts) < len(route.kinds) or (len(parts) > len(route.kinds) and not rest):
            continue
        ok = all(
            part == text if kind == "0" else part != "" or (kind == "2" and len(parts) > len(route.kinds))
            for part, kind, text in zip(parts, route.kinds, route.texts))
        if ok and (best is None or route.rank < best[0]):
            best = (route.rank, i)
    return best and best[1]


def test_rule_tables_by_brute_force(spark):
    draw = random.Random(6)
    parts = ["a", "b", "{x}", "{y}", "{*r}", "{{q}}", "", "c.d"]
    rules, requests = [], []
    for m in range(150):
        for _ in range(draw.randrange(1, 9)):
            pattern = "".join("/" + draw.choice(parts[:5] if m % 2 else parts) for _ in range(draw.randrange(1, 4)))
            rules.append((len(rules), None if draw.random() < 0.03 else pattern, f"M{m}"))
        for _ in range(12):
            path = "".join("/" + draw.choice(["a", "b", "z", "", "{q}", "c.d"]) for _ in range(draw.randrange(1, 5)))
            requests.append((len(requests), f"M{m}", path))
    draw.shuffle(rules)
    requests += [(-1, None, "/a"), (-2, "M1", None), (-3, "M1", ""), (-4, "M1", "a"), (-5, "NONE", "/a")]
    table = spark.createDataFrame(rules, "id int, endpoint_pattern string, http_method string").selectExpr(
        "*", "0.5d as error_rate", "500 as error_code", "'m' as error_message")
    asked = spark.createDataFrame(requests, "request_id int, method string, path string")
    got = {r.request_id: r.rule and r.rule.id for r in RT.match_routes(asked, table).collect()}
    want = {i: by_program(rules, m, p) if m and p is not None else None for i, m, p in requests}
    assert got == want and len({w for w in want.values()}) > 100


def test_many_methods_and_rules(spark):
    """50 methods of 5,000 rules: equal to the program, and a plan as long as that of one rule."""
    def rows(n):
        return spark.range(n).selectExpr(
            "id", "concat('M', id % 50) as http_method",
            "CASE WHEN id < 50 THEN '/{area}/{id}' WHEN id < 100 THEN '/files/{*rest}' WHEN id % 7 = 0 THEN concat('/p', id, '/{x}') "
            "ELSE concat('/p', id, '/x') END as endpoint_pattern",
            "1.0d as error_rate", "500 as error_code", "'m' as error_message")
    asked = spark.range(20_000).selectExpr(
        "id as request_id", "concat('M', id % 50) as method",
        "CASE id % 3 WHEN 0 THEN concat('/p', id * 12, '/x') WHEN 1 THEN concat('/files/', id, '/y') ELSE '/none' END as path")
    matched = RT.match_routes(asked, rows(250_000))
    got = {r.request_id: r.rule and r.rule.id for r in matched.select("request_id", "rule").collect()}
    for i in range(20_000):
        m = i % 50
        want = None if i % 3 == 2 else 50 + m if i % 3 == 1 else m
        rule = i * 12
        if i % 3 == 0 and rule >= 100 and rule < 250_000 and rule % 50 == m:
            want = rule
        assert got[i] == want, i
    lines = lambda df: df._jdf.queryExecution().optimizedPlan().toString().count("\n")
    assert lines(matched) == lines(RT.match_routes(asked, rows(60)))
