"""Personal data by candidate gradient boosting, in DataFrame functions only.

1. Base rules find e-mail addresses, IP addresses, payment cards and phone numbers.
2. High-recall generators propose further, overlapping spans of each kind: looser local
   parts and domains, other separators, numbers without a plus.
3. Boosted trees score every candidate by its format and context. They learn from the
   candidates themselves: those that touch a base span of their kind are positive. Features
   have few levels, so all candidates of the corpus are counted in one small table (at most
   ``LEVELS`` rows), and trees are fitted on it; half of the texts (by hash) train.
4. On the other half, each kind's threshold is the lowest score from which on at least
   ``PRECISION`` of the candidates are positive. Candidates at or above it that touch no
   base span are added; of added spans that touch, the earlier and longer stays.

Offsets are code points. Spark has no function for the places of all matches, so they are
sums of the lengths of the pieces between matches and of the matches; the sums run in
blocks, so that a text with very many matches costs little more than its length.

Patterns start at the beginning of a run of their characters (or where the match before
ended), which is where the leftmost match must start, and give nothing back, so that they
are linear on long runs.

Defined results: null is the empty text, which has no spans; rows are handled one by one,
repeated rows alike; an empty table gives no rows; without positive candidates of a kind
none of that kind is added. Extra columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticklake.llm.common import staged

KINDS = ["email", "ip", "card", "phone"]
PRECISION = 0.98
ROUNDS, RATE, DEPTH = 20, 0.4, 2

# The base rules.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9]++(?:[ -][0-9]++)*+",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
LOOSE = {
    "email": r"(?:\G|(?<![^\s@<>()\[\]{},;\"]))[^\s@<>()\[\]{},;\"]++@[^\s@<>()\[\]{},;\"]++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:[.:_-][0-9]++){3}",
    "card": r"[0-9]++(?:[ ./_-][0-9]++)*+",
    "phone": r"(?<![0-9])(?:\+|00|\()?[0-9](?:[ ./()-]{0,2}+[0-9]){6,19}+",
}
MUST = {"email": "@", "ip": "[0-9]", "card": "[0-9]", "phone": "[0-9]"}

FEATURES = ["digits", "groups", "separator", "before", "after", "check"]
SIZES = {"digits": 10, "groups": 6, "separator": 7, "before": 6, "after": 6, "check": 3}
LEVELS = 2 * len(KINDS) * math.prod(SIZES.values())  # rows of the table, with the halves

_STARTS = """flatten(transform(aggregate(
    transform(sequence(0, (size({0}) - 1) div 512), b -> slice({0}, b * 512 + 1, 512)),
    array(named_struct('pos', 0, 'starts', cast(array() AS array<int>))),
    (acc, block) -> array_append(acc, aggregate(
        block, named_struct('pos', element_at(acc, -1).pos, 'starts', cast(array() AS array<int>)),
        (a, x) -> named_struct('pos', a.pos + x.gap + x.size, 'starts', array_append(a.starts, a.pos + x.gap))
    ))), r -> r.starts))"""


def _located(df: DataFrame, text: str, pattern: str, out: str, when: str) -> DataFrame:
    """Add all matches of a pattern as array<struct<start, stop, match, before, after>>."""
    holds = F.col(text).rlike(when)
    df = df.withColumns({
        "_m": F.when(holds, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(F.array().cast("array<string>")),
        "_p": F.when(holds, F.split(text, pattern, -1)).otherwise(F.array().cast("array<string>")),
    })
    df = df.withColumn("_i", F.expr("""transform(_m, (m, i) -> named_struct(
        'gap', length(_p[i]), 'size', length(m), 'match', m,
        'before', right(_p[i], 1), 'after', left(_p[i + 1], 1)))"""))
    df = df.withColumn("_s", F.expr(_STARTS.format("_i")))
    return df.withColumn(out, F.expr("""zip_with(_i, _s, (x, s) -> named_struct(
        'start', s, 'stop', s + x.size, 'match', x.match, 'before', x.before, 'after', x.after))""")).drop("_m", "_p", "_i", "_s")


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the check sum."""
    places = F.sequence(F.lit(1), F.greatest(F.length(digits), F.lit(1)))

    def add(total: Column, place: Column) -> Column:
        digit = F.coalesce(F.substring(digits, place, F.lit(1)).try_cast("int"), F.lit(0))
        twice = F.when(digit > 4, 2 * digit - 9).otherwise(2 * digit)
        return total + F.when((F.length(digits) - place) % 2 == 1, twice).otherwise(digit)

    return (F.length(digits) > 0) & (F.aggregate(places, F.lit(0), add) % 10 == 0)


def _octets(match: Column) -> Column:
    octet = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
    return match.rlike(rf"^{octet}(?:[.:_-]{octet}){{3}}$")


def _valid(kind: str, match: Column) -> Column:
    digits = F.length(_digits(match))
    if kind == "ip":
        return _octets(match)
    if kind == "card":
        return digits.between(12, 19) & luhn(F.when(digits <= 19, _digits(match)).otherwise("1"))
    if kind == "phone":
        return digits.between(9, 15)
    return F.lit(True)


def _character(char: Column) -> Column:
    """Level of a neighbouring character."""
    return (
        F.when(char.isNull() | (char == ""), 0).when(char.rlike(r"^\s"), 1).when(char.rlike(r"^[=:\"'#]"), 2)
        .when(char.rlike(r"^\p{L}"), 3).when(char.rlike("^[0-9]"), 4).otherwise(5)
    )


def _features(kind: str, x: Column) -> Column:
    match = x["match"]
    digits = F.length(_digits(match))
    if kind == "email":
        check = F.when(match.rlike(r"^[\x21-\x7e]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}[.!?:]*$"), 2).when(
            match.rlike(r"@.*\."), 1).otherwise(0)
    elif kind == "ip":
        check = F.when(_octets(match), 2).otherwise(0)
    elif kind == "card":
        check = F.when(digits.between(12, 19) & luhn(F.when(digits <= 19, _digits(match)).otherwise("1")), 2).otherwise(0)
    else:
        check = F.when(match.rlike(r"[(]"), 2).when(match.rlike("[ -]"), 1).otherwise(0)
    level = F.lit(0)
    for place, least in enumerate([1, 4, 7, 9, 10, 12, 16, 17, 20]):
        level = F.when(digits >= least, place + 1).otherwise(level)
    runs = F.least(F.size(F.split(match, "[0-9]+", -1)) - 1, F.lit(5))
    separator = F.lit(0)
    for place, mark in enumerate(["-", " ", ".", "/", "_", ":"]):
        separator = F.when(F.contains(match, F.lit(mark)), place + 1).otherwise(separator)
    return F.struct(
        F.lit(KINDS.index(kind)).alias("kind"), x["start"].alias("start"), x["stop"].alias("stop"),
        level.cast("int").alias("digits"), runs.cast("int").alias("groups"), separator.cast("int").alias("separator"),
        _character(x["before"]).cast("int").alias("before"), _character(x["after"]).cast("int").alias("after"),
        check.cast("int").alias("check"),
    )


def _base_of(kind: str) -> Column:
    place = KINDS.index(kind)
    return F.transform(
        F.filter(f"b_{kind}", lambda x: _valid(kind, x["match"])),
        lambda x: F.struct(x["start"].alias("start"), F.lit(place).alias("kind"), x["stop"].alias("stop")),
    )


def _candidates_of(kind: str) -> Column:
    shortest = 3 if kind == "email" else 7
    return F.transform(
        F.filter(f"c_{kind}", lambda x: F.length(x["match"]) >= shortest), lambda x: _features(kind, x)
    )


def found_spans(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Per row: id, half, ``base`` spans and ``more`` candidates with features, by start."""
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("half", (F.crc32(F.col("text").cast("binary")) % 2).cast("int"))
    for kind in KINDS:
        rows = _located(rows, "text", BASE[kind], f"b_{kind}", r"\+" if kind == "phone" else MUST[kind])
        rows = _located(rows, "text", LOOSE[kind], f"c_{kind}", MUST[kind])
    base = [_base_of(kind) for kind in KINDS]
    more = [_candidates_of(kind) for kind in KINDS]
    return rows.select("id", "half", F.array_sort(F.concat(*base)).alias("base"), F.concat(*more).alias("more"))


# Among sorted spans, whether one touches x; kinds of base spans as wished.
_TOUCHED = "exists({spans}, b -> b.start < x.stop AND b.stop > x.start {same})"


def level_counts(found: DataFrame) -> DataFrame:
    """Candidates and positive ones of every combination of levels; at most LEVELS rows."""
    names = ["kind", *FEATURES]
    marked = found.filter("size(more) > 0").select("half", F.expr(
        "inline(transform(more, x -> named_struct("
        + ", ".join(f"'{n}', x.{n}" for n in names)
        + ", 'positive', " + _TOUCHED.format(spans="base", same="AND b.kind = x.kind") + ")))"
    ))
    return marked.groupBy("half", *names).agg(
        F.count("*").alias("n"), F.sum(F.col("positive").cast("int")).alias("positives")
    )


def grown(levels: np.ndarray, n: np.ndarray, positives: np.ndarray) -> list:
    """Boosted trees over a table of level combinations, for the logistic loss.

    A tree is (feature, level, left, right), left for levels up to the level, or a number.
    """
    rate = (positives.sum() + 0.5) / (n.sum() + 1)
    trees: list = [float(np.log(rate / (1 - rate)))]
    margin = np.full(len(n), trees[0])
    for _ in range(ROUNDS):
        p = 1 / (1 + np.exp(-margin))
        tree = _tree(levels, positives - n * p, n * p * (1 - p), np.ones(len(n), bool), DEPTH)
        trees.append(tree)
        margin += _applied(tree, levels)
    return trees


def _tree(levels: np.ndarray, slope: np.ndarray, bend: np.ndarray, here: np.ndarray, depth: int):
    gain_of = lambda rows: slope[rows].sum() ** 2 / (bend[rows].sum() + 1.0)
    leaf = float(RATE * slope[here].sum() / (bend[here].sum() + 1.0))
    best = (gain_of(here) + 1e-6, None, None)
    for feature in range(levels.shape[1]) if depth else ():
        for level in np.unique(levels[here, feature])[:-1]:
            left = here & (levels[:, feature] <= level)
            gain = gain_of(left) + gain_of(here & ~left)
            if gain > best[0]:
                best = (gain, feature, int(level))
    _, feature, level = best
    if feature is None:
        return leaf
    left = here & (levels[:, feature] <= level)
    return (feature, level, _tree(levels, slope, bend, left, depth - 1), _tree(levels, slope, bend, here & ~left, depth - 1))


def _applied(tree, levels: np.ndarray) -> np.ndarray:
    if isinstance(tree, float):
        return np.full(len(levels), tree)
    feature, level, left, right = tree
    return np.where(levels[:, feature] <= level, _applied(left, levels), _applied(right, levels))


def threshold(margins: np.ndarray, n: np.ndarray, positives: np.ndarray) -> float:
    """The lowest margin from which on enough candidates are positive."""
    order = np.argsort(-margins, kind="stable")
    precision = np.cumsum(positives[order]) / np.maximum(1, np.cumsum(n[order]))
    last = np.append(margins[order][1:] < margins[order][:-1], True)  # ends of equal margins
    good = np.flatnonzero(last & (precision >= PRECISION))
    return float(margins[order][good[-1]]) if len(good) else math.inf


def fit(found: DataFrame) -> dict[str, tuple[list, float]]:
    """Trees and threshold of every kind with positive candidates in both halves."""
    rows = level_counts(found).collect()  # bounded by LEVELS
    model = {}
    for place, kind in enumerate(KINDS):
        halves = []
        for half in (0, 1):
            mine = [r for r in rows if r["kind"] == place and r["half"] == half]
            mine.sort(key=lambda r: [r[f] for f in FEATURES])
            halves.append((
                np.array([[r[f] for f in FEATURES] for r in mine], dtype=int).reshape(-1, len(FEATURES)),
                np.array([r["n"] for r in mine], dtype=float), np.array([r["positives"] for r in mine], dtype=float),
            ))
        (levels, n, positives), (other, m, hits) = halves
        if positives.sum() and hits.sum():
            trees = grown(levels, n, positives)
            model[kind] = trees, threshold(sum(_applied(t, other) for t in trees), m, hits)
    return model


def _as_sql(tree) -> str:
    if isinstance(tree, float):
        return f"{tree!r}D"
    feature, level, left, right = tree
    return f"CASE WHEN x.{FEATURES[feature]} <= {level} THEN {_as_sql(left)} ELSE {_as_sql(right)} END"


def select(found: DataFrame, model: dict[str, tuple[list, float]]) -> DataFrame:
    """Add ``added``: candidates at or above their threshold that touch no base span."""
    chosen = " OR ".join(
        f"(x.kind = {KINDS.index(kind)} AND {' + '.join(map(_as_sql, trees))} >= {least!r}D)"
        for kind, (trees, least) in model.items() if math.isfinite(least)
    ) or "false"
    touched = _TOUCHED.format(spans="base", same="")
    return found.withColumn("_a", F.expr(f"""array_sort(transform(
        filter(filter(more, x -> {chosen}), x -> NOT {touched}),
        x -> named_struct('start', x.start, 'back', -x.stop, 'kind', x.kind)))""")).withColumn("added", F.expr("""
        aggregate(_a, cast(array() AS array<struct<start:int,kind:int,stop:int>>), (acc, x) ->
            CASE WHEN size(acc) > 0 AND element_at(acc, -1).stop > x.start THEN acc
                 ELSE array_append(acc, named_struct('start', x.start, 'kind', x.kind, 'stop', -x.back)) END)""")).drop("_a")


def _joined(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(
        ":", F.element_at(names, x["kind"] + 1), x["start"].cast("string"), x["stop"].cast("string"))), ",")


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, base spans per kind, ``base_sha256``, all ``spans``."""
    found = staged(found_spans(docs, id_col, text_col), "spans")
    chosen = select(found, fit(found))
    count = lambda place: F.size(F.filter("base", lambda x: x["kind"] == place)).cast("long")
    return chosen.select(
        F.col("id").alias(id_col), *(count(p).alias(f"n_{k}") for p, k in enumerate(KINDS)),
        F.sha2(_joined(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        _joined(F.array_sort(F.concat("base", "added"))).alias("spans"), F.size("added").cast("long").alias("n_added"),
    )


def redacted(text: Column, spans: Column) -> Column:
    """The text with every span (as joined by ``personal_data``) replaced by its kind."""
    parts = F.transform(F.filter(F.split(spans, ","), lambda s: s != ""), lambda s: F.split(s, ":"))
    start, stop = (lambda s: s[1].cast("int")), (lambda s: s[2].cast("int"))
    done = F.aggregate(
        parts, F.struct(F.lit("").alias("out"), F.lit(0).alias("at")),
        lambda acc, s: F.struct(
            F.when(start(s) < acc["at"], acc["out"]).otherwise(F.concat(
                acc["out"], F.substring(text, acc["at"] + 1, start(s) - acc["at"]), F.lit("<"), s[0], F.lit(">"))).alias("out"),
            F.greatest(acc["at"], stop(s)).alias("at"),
        ),
    )
    return F.concat(done["out"], F.substring(text, done["at"] + 1, F.length(text)))
