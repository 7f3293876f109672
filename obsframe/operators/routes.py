"""Path patterns: matching, templates and error injection.

``match_routes`` meets a table of rules of any size by joins; ``route_template`` takes
patterns that are written in the program and compiles them into one expression.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from obsframe.functions.scalars import as_col, http_reason, uniform_draw

_STATIC, _PARAM, _REST = "0", "1", "2"


@dataclass(frozen=True)
class Route:
    pattern: str
    kinds: tuple[str, ...]
    texts: tuple[str, ...]

    @staticmethod
    def parse(pattern: str) -> Route:
        """``{x}`` is one non-empty segment, a final ``{*x}`` everything that is left."""
        kinds, texts = [], []
        for segment in pattern.split("/"):
            if re.fullmatch(r"\{\*[^{}]+\}", segment):
                kinds.append(_REST)
                texts.append("")
            elif re.fullmatch(r"\{[^{}*]+\}", segment):
                kinds.append(_PARAM)
                texts.append("")
            else:
                kinds.append(_STATIC)
                texts.append(segment.replace("{{", "{").replace("}}", "}"))
        return Route(pattern, tuple(kinds), tuple(texts))

    @property
    def is_valid(self) -> bool:
        return self.pattern.startswith("/") and _REST not in self.kinds[:-1]

    @property
    def rank(self) -> str:
        """Smaller wins, segment by segment: static, parameter, rest."""
        return "".join(self.kinds)

    def conflicts_with(self, other: Route) -> bool:
        """Same shape, or a parameter and a rest at the same place."""
        for a, b in zip(zip(self.kinds, self.texts), zip(other.kinds, other.texts)):
            if a != b:
                return {a[0], b[0]} == {_PARAM, _REST}
        return len(self.kinds) == len(other.kinds)

    def matches(self, path: Column) -> Column:
        if set(self.kinds) == {_STATIC}:
            return path == "/".join(self.texts)
        parts = {_PARAM: "[^/]+", _REST: "(?s:.+)"}
        body = "/".join(
            parts.get(kind) or "".join("\\" + c if not c.isalnum() and ord(c) < 128 else c for c in text)
            for kind, text in zip(self.kinds, self.texts)
        )
        return path.rlike(f"^{body}\\z")


def _admit(patterns: Sequence[str]) -> list[tuple[int, Route]]:
    """Routes in order of precedence; invalid and conflicting later ones are left out."""
    kept: list[tuple[int, Route]] = []
    for i, pattern in enumerate(patterns):
        route = Route.parse(pattern)
        if route.is_valid and not any(route.conflicts_with(other) for _, other in kept):
            kept.append((i, route))
    return sorted(kept, key=lambda entry: entry[1].rank)


def _case(branches: Sequence[tuple[Column, Column]]) -> Column | None:
    out = None
    for condition, value in branches:
        out = F.when(condition, value) if out is None else out.when(condition, value)
    return out


def _first_match(path: Column, entries: Sequence[tuple[Column, Route]]) -> Column:
    out = _case([(route.matches(path), value) for value, route in entries])
    return F.lit(None) if out is None else out


def route_template(path, patterns: Sequence[str]) -> Column:
    """The pattern a path belongs to, or NULL: ``/books/7`` gives ``/books/{id}``."""
    entries = [(F.lit(route.pattern), route) for _, route in _admit(patterns)]
    return _first_match(as_col(path), entries).cast("string")


_RULE_FIELDS = ("id", "endpoint_pattern", "error_rate", "error_code", "error_message")
_RULE_TYPE = (
    "struct<id:bigint,endpoint_pattern:string,error_rate:double,error_code:int,error_message:string>"
)


def _segments(path: Column) -> Column:
    return F.split(path, "/", -1)


def route_table(configs: DataFrame, per_method: int | None = None) -> DataFrame:
    """Rules as a path trie: (method, kinds, place, rule), a row per rule that counts.

    ``kinds`` has a digit per segment, static, parameter or rest, and ``place`` the
    segments with the wildcards left out; the two name a leaf of the trie.  Of rules with
    the same leaf the oldest counts.  A node with wildcards has either parameters or a
    rest below it, and the oldest rule with a wildcard there decides which: rules of the
    other kind do not count.  (An older rule that does not count itself decides as well:
    whatever kept it out keeps those out that it would have let in.)
    """
    rules = configs.filter(F.col("http_method").isNotNull() & F.col("endpoint_pattern").isNotNull())
    if per_method is not None:
        oldest = W.partitionBy("http_method").orderBy("id")
        rules = rules.withColumn("_n", F.row_number().over(oldest)).filter(F.col("_n") <= per_method)
    kind = lambda s: (
        F.when(s.rlike(r"\A\{\*[^{}]+\}\z"), _REST).when(s.rlike(r"\A\{[^{}*]+\}\z"), _PARAM).otherwise(_STATIC)
    )
    static = lambda s: F.when(
        kind(s) == _STATIC, F.replace(F.replace(s, F.lit("{{"), F.lit("{")), F.lit("}}"), F.lit("}"))
    ).otherwise("")
    parsed = rules.select(
        F.col("http_method").alias("method"),
        F.struct(*_RULE_FIELDS).cast(_RULE_TYPE).alias("rule"),
        F.array_join(F.transform(_segments(F.col("endpoint_pattern")), kind), "").alias("kinds"),
        F.array_join(F.transform(_segments(F.col("endpoint_pattern")), static), "/").alias("place"),
    ).filter(F.col("rule.endpoint_pattern").startswith("/") & ~F.col("kinds").rlike(f"{_REST}."))
    leaves = parsed.groupBy("method", "kinds", "place").agg(F.min_by("rule", "rule.id").alias("rule"))
    at = F.sequence(F.lit(1), F.length("kinds"))
    wild = F.transform(
        F.filter(at, lambda i: F.substring("kinds", i, F.lit(1)) != _STATIC),
        lambda i: F.struct(
            F.substring("kinds", i, F.lit(1)).alias("kind"),
            F.concat(
                F.substring("kinds", F.lit(1), i - 1), F.lit("/"), F.array_join(F.slice(_segments(F.col("place")), 1, i - 1), "/"),
            ).alias("node"),
        ),
    )
    nodes = leaves.select("method", "kinds", "place", "rule.id", F.inline(wild))
    claims = nodes.groupBy("method", "node").agg(F.min_by("kind", "id").alias("claim"))
    kept_out = nodes.join(claims, ["method", "node"]).filter("kind <> claim")
    return leaves.join(kept_out, ["method", "kinds", "place"], "left_anti")


def match_routes(
    requests: DataFrame, configs: DataFrame, out: str = "rule", per_method: int | None = None
) -> DataFrame:
    """Add the winning rule of each request; at most one, NULL if none.

    Every distinct method and path is masked by the wildcard patterns that are in use for
    its method and length, and each masked form meets the rules by equality; the smallest
    pattern wins, segment by segment: static, parameter, rest.  So a path meets as many
    rows as there are patterns of wildcards, not as there are rules; nothing is read to
    the driver but the length of the longest pattern with a rest; and the plan is the
    same for any number of rules.  The rules are written once as a trie, so Spark knows
    their size: small ones are broadcast and paths are not shuffled to meet them.
    Methods are few, so they are spread by a salt where patterns are joined.

    ``per_method`` keeps the oldest so many rules of each method; by default all count.
    """
    from obsframe.plans.session import written_once  # plans are made of operators

    salts = int(requests.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rules = written_once(route_table(configs, per_method), "routes")
    length = F.length("kinds")
    masks = rules.select(
        "method", "kinds", length.alias("length"), F.endswith("kinds", F.lit(_REST)).alias("rest")
    ).distinct()
    longest = masks.filter("rest").agg(F.max("length").alias("length")).scalar()
    paths = (
        requests.select("method", "path")
        .filter(F.col("method").isNotNull() & F.col("path").isNotNull())
        .distinct()
        .withColumn("segments", _segments(F.col("path")))
        .withColumn("n", F.size("segments"))
    )
    reach = F.least(F.col("n"), F.coalesce(longest, F.lit(0)))
    # the whole path, and each of its beginnings that a rest may follow
    form = F.explode(F.sequence(F.lit(0), reach)).alias("form")
    asked = paths.select("*", form).withColumns({
        "length": F.when(F.col("form") == 0, F.col("n")).otherwise(F.col("form")),
        "rest": F.col("form") > 0,
        "salt": F.pmod(F.xxhash64("path"), F.lit(salts)),
    })
    salted = masks.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)).cast("array<bigint>")))
    met = asked.join(salted, ["method", "length", "rest", "salt"])
    kind = lambda i: F.substring("kinds", i + 1, F.lit(1))
    head = F.slice("segments", 1, F.col("length"))
    filled = F.forall(
        F.transform(head, lambda s, i: (s != "") | (kind(i) == _STATIC) | ((kind(i) == _REST) & (F.col("n") > F.col("length")))),
        lambda ok: ok,
    )
    masked = F.array_join(F.transform(head, lambda s, i: F.when(kind(i) == _STATIC, s).otherwise("")), "/")
    found = (
        met.filter(filled)
        .select("method", "path", "kinds", masked.alias("place"))
        .join(rules, ["method", "kinds", "place"])
        .groupBy("method", "path")
        .agg(F.min_by("rule", "kinds").alias(out))
        .withColumnsRenamed({"method": "_method", "path": "_path"})
    )
    same = (F.col("method") == F.col("_method")) & (F.col("path") == F.col("_path"))
    return requests.join(found, same, "left").drop("_method", "_path")


def inject_errors(
    requests: DataFrame, configs: DataFrame, seed: int = 42, key: str = "request_id",
    per_method: int | None = None,
) -> DataFrame:
    """Decide per request whether its rule's error replaces the response.

    The draw depends only on seed and key, so a retried task decides the same.
    """
    draw = uniform_draw(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))
    hit = F.coalesce(draw < F.col("rule.error_rate"), F.lit(False))
    body = F.coalesce(F.col("rule.error_message"), http_reason(F.col("rule.error_code")))
    return (
        match_routes(requests, configs, per_method=per_method)
        .withColumn("injected", hit)
        .withColumn("status", F.when(F.col("injected"), F.col("rule.error_code")))
        .withColumn("body", F.when(F.col("injected"), body))
    )
