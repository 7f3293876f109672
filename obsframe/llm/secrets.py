"""Secrets by three patterns, and random-looking tokens by a battery of randomness tests.

The patterns give the base spans. Every other run of 20 or more encoding characters with
letters and digits is a candidate: the smallest alphabet that holds it (hex, base32, base64,
base64url) is its inferred encoding. The battery tests its symbols for what a random key must
be: uniform over the alphabet (chi-squared), without trend above and below the middle (runs)
and without lag-one serial correlation. A candidate that fails a test is no secret. One that
passes has a p-value for the opposite case, ordinary text: the token's likelihood as written
text over its likelihood as uniform symbols of its encoding, which under ordinary text is at
most x with a chance of at most x. Written text has its usual letters, goes on to the same or
the next character at times, and changes between lower case, capitals, digits and signs with
``CHANGE_CHANCE`` per character. The evidence of every symbol adds up, so it grows with length.

All candidates' p-values are weighted by length, with weights of mean 1 over the table, and
held to a false-discovery rate of ``RATE`` by the step-up rule, over the whole table: Spark
counts candidates by weighted p-value in at most ``LEVELS`` classes, so what the driver sees
does not grow.

Defined cases: a NULL or empty text has no spans; NULL doc_ids and repeated rows are scanned
one by one; long texts are scanned whole; an empty table gives no rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsframe.llm.common import in_batches, set_aside, written

KINDS = ("assign", "access", "hex", "random")
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{16,}"
CANDIDATE = r"[A-Za-z0-9+/_-]{20,}"
LEAST_ASSIGNED, LEAST_ACCESS = 12, 18
DIGITS, CAPITALS = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Encodings by rising size of their alphabets, in order of symbol value.
ENCODINGS = (
    ("hex", DIGITS + CAPITALS[:6]),
    ("hex", DIGITS + CAPITALS[:6].lower()),
    ("base32", CAPITALS + "234567"),
    ("base64", CAPITALS + CAPITALS.lower() + DIGITS + "+/"),
    ("base64url", CAPITALS + CAPITALS.lower() + DIGITS + "-_"),
)
#: A test fails a token whose statistic is so many standard errors from a random token's.
UNIFORM_LIMIT, OTHER_LIMIT = 5.0, 3.6
CHANGE_CHANCE = 0.2
#: Chance that written text goes on to the same or the next character, as in 000 and 123.
STEP_CHANCE = 0.2
#: Percent of each letter from a to z in written text, and the part that is even over all letters.
LETTER_PERCENT = (8.2, 1.5, 2.8, 4.3, 12.7, 2.2, 2.0, 6.1, 7.0, 0.15, 0.77, 4.0, 2.4, 6.7, 7.5, 1.9, 0.1, 6.0, 6.3, 9.1,
                  2.8, 0.98, 2.4, 0.15, 2.0, 0.07)
EVEN_PART = 0.15
RATE = 0.01
#: Weight 1 begins at this length; shorter tokens weigh in proportion.
FULL_WEIGHT_LENGTH = 64
LEVELS = 256
MARK = "[secret]"


def base_spans(text: str, assign: re.Pattern, access: re.Pattern, hexes: re.Pattern) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the three patterns, sorted."""
    spans = [(m.start(), 0, m.end()) for m in assign.finditer(text) if len(m[2]) >= LEAST_ASSIGNED]
    spans += [(m.start(), 1, m.end()) for m in access.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    spans += [(m.start(), 2, m.end()) for m in hexes.finditer(text)]
    return sorted(spans)


def encoding_of(token: str) -> tuple[str, str] | None:
    """Name and alphabet of the smallest encoding that holds a token of letters and digits."""
    held = set(token)
    if not any(c.isdigit() for c in held) or not any(c.isalpha() for c in held):
        return None
    return next((e for e in ENCODINGS if held <= set(e[1])), None)


def battery(token: str, alphabet: str) -> dict[str, float]:
    """Standardised chi-squared, runs and serial-correlation statistics under randomness."""
    n, size = len(token), len(alphabet)
    expected = n / size
    counts = Counter(token)
    spread = sum((counts[c] - expected) ** 2 for c in alphabet) / expected
    uniform = (spread - (size - 1)) / math.sqrt(2 * (size - 1) * (n - 1) / n)
    values = [alphabet.index(c) for c in token]
    above = [2 * v >= size for v in values]
    high = sum(above)
    low = n - high
    runs = 1 + sum(a != b for a, b in zip(above, above[1:]))
    mean = 1 + 2 * high * low / n
    variance = (mean - 1) * (mean - 2) / (n - 1)
    centre = sum(values) / n
    power = sum((v - centre) ** 2 for v in values)
    serial = sum((a - centre) * (b - centre) for a, b in zip(values, values[1:])) / power if power else 1.0
    return {
        "uniform": uniform,
        "runs": (runs - mean) / math.sqrt(variance) if variance > 0 else math.inf,
        "serial": serial * math.sqrt(n) + 1 / math.sqrt(n),
    }


def looks_random(token: str, alphabet: str) -> bool:
    tests = battery(token, alphabet)
    return (tests["uniform"] <= UNIFORM_LIMIT and abs(tests["runs"]) <= OTHER_LIMIT
            and abs(tests["serial"]) <= OTHER_LIMIT)


def _text_bits() -> dict[tuple[str, str], float]:
    """-log2 of the chance in written text of a character after another, or after "" at the start."""
    whole = sum(LETTER_PERCENT)
    letters = [(1 - EVEN_PART) * x / whole + EVEN_PART / 26 for x in LETTER_PERCENT]
    classes = [
        dict(zip(CAPITALS.lower(), letters)), dict(zip(CAPITALS, letters)),
        dict.fromkeys(DIGITS, 1 / len(DIGITS)), dict.fromkeys("+/_-", 1 / 4)]
    bits = {}
    for shares in classes:
        order = "".join(shares)
        for at, (c, share) in enumerate(shares.items()):
            bits["", c] = -math.log2(share / len(classes))
            for other in classes:
                for before in other:
                    chance = CHANGE_CHANCE / (len(classes) - 1) * share
                    if other is shares:
                        stepped = at - order.index(before) in (0, 1)
                        chance = (1 - CHANGE_CHANCE) * ((1 - STEP_CHANCE) * share + STEP_CHANCE / 2 * stepped)
                    bits[before, c] = -math.log2(chance)
    return bits


TEXT_BITS = _text_bits()


def weight_of(length: int) -> float:
    return min(length, FULL_WEIGHT_LENGTH) / FULL_WEIGHT_LENGTH


def level_of(token: str, alphabet: str) -> int:
    """Whole bits of evidence against ordinary text: -log2 of the length-weighted p-value.

    Each encoding has an equal part of the random case, as the token chose its own.
    """
    written_bits = sum(TEXT_BITS[pair] for pair in zip(["", *token], token))
    random_bits = len(token) * math.log2(len(alphabet)) + math.log2(len(ENCODINGS))
    bits = max(written_bits - random_bits, 0.0) + math.log2(weight_of(len(token)))
    return min(max(int(bits), 0), LEVELS - 1)


def _scanner() -> Callable[[str | None], tuple[list[dict], list[dict]]]:
    assign = re.compile(ASSIGN, re.IGNORECASE | re.ASCII)
    access, hexes, candidate = re.compile(ACCESS), re.compile(HEX), re.compile(CANDIDATE)

    def scanned(text: str | None) -> tuple[list[dict], list[dict]]:
        """Base spans and tested tokens of a text."""
        text = text or ""
        spans = base_spans(text, assign, access, hexes)
        tokens = []
        for m in candidate.finditer(text):
            if any(start < m.end() and m.start() < end for start, _, end in spans):
                continue
            encoding = encoding_of(m[0])
            if encoding:
                random = looks_random(m[0], encoding[1])
                tokens.append({"start": m.start(), "end": m.end(), "encoding": encoding[0],
                               "level": level_of(m[0], encoding[1]) if random else -1})
        return [{"start": s, "kind": k, "end": e} for s, k, e in spans], tokens

    return scanned


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    scanned = _scanner()
    for batch in batches:
        found = [scanned(text) for text in batch.column("text").to_pylist()]
        # the ids stay in Arrow: pandas makes doubles of them where some are NULL
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array([f[0] for f in found], BASE), pa.array([f[1] for f in found], TOKENS)],
            ["doc_id", "base", "tokens"])


BASE = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())]))
TOKENS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("encoding", pa.string()), ("level", pa.int32())]))
SCANNED = (
    "doc_id bigint, base array<struct<start:bigint,kind:int,end:bigint>>, "
    "tokens array<struct<start:bigint,end:bigint,encoding:string,level:int>>"
)


def scan(docs: DataFrame, rowid: str = "doc_id") -> DataFrame:
    """doc_id, base spans and tested tokens of every document."""
    return in_batches(docs).select(F.col(rowid).cast("bigint").alias("doc_id"), "text").mapInArrow(_scan, SCANNED)


def needed_level(scanned: DataFrame, rate: float = RATE) -> int:
    """The lowest level at which the step-up rule holds the false-discovery rate over all tokens."""
    tokens = scanned.select(F.explode("tokens").alias("token")).select(
        "token.level", F.least(F.col("token.end") - F.col("token.start"), F.lit(FULL_WEIGHT_LENGTH)).alias("length"))
    counts = tokens.groupBy("level").agg(F.count("*").alias("held"), F.sum("length").alias("length")).collect()
    held = {r["level"]: r["held"] for r in counts}  # at most LEVELS + 1 classes
    total = sum(r["length"] for r in counts) / FULL_WEIGHT_LENGTH  # of the weights, which makes their mean 1
    at_least = 0
    needed = LEVELS
    for level in range(LEVELS - 1, -1, -1):
        at_least += held.get(level, 0)
        if at_least and 2.0 ** -level <= rate * at_least / total:
            needed = level
    return needed


def spans_of(scanned: DataFrame, rate: float = RATE) -> DataFrame:
    """Adds ``spans``: base spans and discovered tokens as (start, kind number, end), sorted.

    ``scanned`` is read twice, so it should be ``written``.
    """
    needed = needed_level(scanned, rate)
    discovered = F.transform(
        F.filter("tokens", lambda t: t["level"] >= needed),
        lambda t: F.struct(t["start"].alias("start"), F.lit(KINDS.index("random")).alias("kind"), t["end"].alias("end")))
    return scanned.withColumn("spans", F.sort_array(F.concat("base", discovered)))


def joined(spans: str) -> Column:
    """kind:start:end of every span, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def counted(spans: str, kind: str) -> Column:
    """BIGINT number of spans of a kind."""
    # a filter's function of two arguments would get the place in the array as its second
    return F.size(F.filter(spans, lambda s: s["kind"] == KINDS.index(kind))).cast("bigint")


def found(docs: DataFrame, rate: float = RATE) -> DataFrame:
    """doc_id, base and all spans of every document."""
    return spans_of(written(scan(docs), "secret-scan"), rate)


def _masker(column: str, needed: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def mask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanned = _scanner()
        for batch in batches:
            at_column = batch.schema.get_field_index(column)
            clean = []
            for text in batch.column(at_column).to_pylist():
                base, tokens = scanned(text)
                spans = sorted([(s["start"], s["end"]) for s in base]
                               + [(t["start"], t["end"]) for t in tokens if t["level"] >= needed])
                parts, at = [], 0
                for start, end in spans:
                    if start >= at:
                        parts += [text[at:start], MARK]
                    at = max(at, end)
                clean.append("".join([*parts, text[at:]]) if spans else text)
            yield batch.set_column(at_column, batch.schema.field(at_column), pa.array(clean, batch.schema.field(at_column).type))
    return mask


def masked(docs: DataFrame, rate: float = RATE) -> DataFrame:
    """The documents with every secret replaced by ``MARK``; overlapping spans become one mark.

    Documents without secrets are returned as they are. ``n_chars``, if there, is counted
    anew where the text changed.
    """
    named, given_back = set_aside(docs, "doc_id", "text", "n_chars")
    needed = needed_level(written(scan(named), "secret-scan"), rate)
    kept = named.withColumn("_clean", F.col("text"))
    out = in_batches(kept).mapInArrow(_masker("_clean", needed), kept.schema)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(
            F.col("_clean") != F.col("text"), F.length("_clean").cast(docs.schema["n_chars"].dataType)).otherwise(
            F.col("n_chars")))
    return given_back(out.withColumn("text", F.col("_clean")))
