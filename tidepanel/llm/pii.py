"""Personal data: base patterns, and spans that boosted trees choose among proposed candidates. DataFrame operations only.

Positions come from marking: a replacement sets a private-use character before and after each match, and the lengths
of the pieces between the marks add up to code-point offsets. Patterns use possessive runs and single-character loops
only, so they take linear time and no stack on long texts; they find the same matches as the plain patterns in BASE.

Generators with high recall propose candidates (KINDS beyond the base ones, and near misses of these). Each candidate
has a strict check of its own generator (checksum, ranges, a naming word before it). The trees learn from format and
context features, in bins, what passing candidates look like; the words that name a thing are not among the features, so that a
candidate which looks like the named ones passes without a name. What is gathered for fitting is the count of each
combination of bins over all documents; there are at most as many as the product of the bins, whatever the input. Half of the combinations' documents fit the
trees, the other half calibrates: per generator, the least score from which on the share of passing candidates is at
least PRECISION. Chosen spans that overlap no base span are added.

Defined results: a null text is an empty one, with no spans and the hash of an empty string; private-use characters
in a text never match; very long texts are searched whole; repeated rows get equal results; an empty table gives no rows; other
columns, whatever their names, are ignored by personal_data() and kept by redacted().
"""

from __future__ import annotations

from collections.abc import Sequence
from math import exp, log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

#: kind: pattern; these are the contract's patterns.
BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
KINDS = (*BASE, "number", "national", "account", "secret")
MARK, JOIN, OTHER = "\ue002", "\ue000", "\ue001"
_EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
_IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
_CARD = rf"[0-9{JOIN}]{{14,}}+"
_PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
_NUMBER = rf"[0-9{JOIN}]{{9,}}+"
_NATIONAL = r"(?<![0-9A-Za-z])\(?[0-9]{2,4}\)?[\x20.-][0-9]{3,4}[\x20.-][0-9]{3,4}(?![0-9A-Za-z])"
_ACCOUNT = r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}(?![0-9A-Za-z])"
_SECRET = r"(?<![0-9A-Za-z_])[0-9A-Za-z_]{24,128}(?![0-9A-Za-z_])"
ASSIGNED = r"[=:][\"'\x20]{0,3}$"
#: Items that are folded at a time, so that appending to a long result stays cheap.
PART = 256
TREES, RATE, LEAST, PRECISION = 24, 0.3, 5, 0.9
FEATURES = ("gen", "digits", "letters", "gaps", "round", "dots", "before", "after", "assigned", "kinds")
_SPAN = "array<struct<start: int, end: int, word: string>>"


def _folded(items: str, kind: str, step: str, end: str = "s -> flatten(s.out)") -> str:
    """SQL: the array items folded by step, an expression of the item x and of a (at, odd, and out: an array of kind)."""
    start = lambda at, odd, kind: f"named_struct('at', {at}, 'odd', {odd}, 'out', cast(array() as array<{kind}>))"
    part = f"aggregate(part, {start('s.at', 's.odd', kind)}, (a, x) -> {step})"
    parts = f"transform(array({items}), p -> transform(sequence(0, greatest(size(p) - 1, 0) div {PART}), g -> slice(p, {PART} * g + 1, {PART})))[0]"
    return f"""aggregate({parts}, {start(0, "false", f"array<{kind}>")}, (s, part) ->
        transform(array({part}), r -> named_struct('at', r.at, 'odd', r.odd, 'out', array_append(s.out, r.out)))[0], {end})"""


def _matches(text: str, pattern: str) -> Column:
    """Spans of a pattern's matches in a column without MARK."""
    quoted = pattern.replace("\\", "\\\\").replace("'", "\\'")
    pieces = f"split(regexp_replace({text}, '{quoted}', '{MARK}$0{MARK}'), '{MARK}', -1)"
    step = """named_struct('at', a.at + length(x), 'odd', not a.odd, 'out',
        if(a.odd, array_append(a.out, named_struct('start', a.at, 'end', a.at + length(x), 'word', x)), a.out))"""
    return F.expr(_folded(pieces, "struct<start: int, end: int, word: string>", step))


def _where(condition: str, spans: Column) -> Column:
    return F.when(F.expr(condition), spans).otherwise(F.expr(f"cast(array() as {_SPAN})"))


def _digits(word: str = "x.word") -> str:
    return f"length(regexp_replace({word}, '[^0-9]', ''))"


_OCTETS = "forall(split(x.word, '[.]'), o -> coalesce(length(ltrim('0', o)) <= 3 and coalesce(try_cast(ltrim('0', o) as int), 0) <= 255, false))"
_LUHN = "luhn_check(regexp_replace(x.word, '[^0-9]', ''))"


def base_spans(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """docs with columns email, ip, card, phone (spans) and the columns _t, _c, which hold the prepared text."""
    clean = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    private = F.expr(f"contains(_t, '{MARK}') or contains(_t, '{JOIN}')")
    out = docs.withColumn("_t", clean).withColumn("_t", F.when(private, F.translate("_t", MARK + JOIN, OTHER * 2)).otherwise(F.col("_t")))
    out = out.withColumn("_d", F.expr("_t rlike '[0-9]'"))
    out = out.withColumn("_c", F.when(F.col("_d"), F.regexp_replace("_t", r"(?<=[0-9])[\x20-](?=[0-9])", JOIN)).otherwise(F.lit("")))
    out = out.withColumns(
        {
            "email": _where("contains(_t, '@')", _matches("_t", _EMAIL)),
            "ip": _where("_d and contains(_t, '.')", _matches("_t", _IP)),
            "card": _where("_d", _matches("_c", _CARD)),
            "phone": _where("_d and contains(_t, '+')", _matches("_t", _PHONE)),
        }
    )
    return out.withColumns(
        {
            "ip": F.expr(f"filter(ip, x -> {_OCTETS})"),
            "card": F.expr(f"filter(card, x -> {_digits()} between 14 and 19 and {_LUHN})"),
            "phone": F.expr(f"filter(phone, x -> {_digits()} between 10 and 15)"),
        }
    )


def _bin(value: str, *edges: int) -> str:
    return "case " + " ".join(f"when {value} < {e} then {i}" for i, e in enumerate(edges)) + f" else {len(edges)} end"


def _char(value: str) -> str:
    return f"case when {value} = '' or {value} rlike '^\\\\s' then 0 when {value} rlike '^[A-Za-z]' then 1 when {value} rlike '^[0-9]' then 2 else 3 end"


def candidates(base: DataFrame) -> DataFrame:
    """base_spans with a column candidates: kind (place in KINDS), start, end, strict check and binned features."""
    checks = {
        1: ("_d and contains(_t, '.')", "_t", _IP, _OCTETS),
        4: ("_d", "_c", _NUMBER, f"{_digits()} between 14 and 19 and {_LUHN}"),
        5: ("_d", "_t", _NATIONAL, "substring(_t, greatest(1, x.start - 3), 4) rlike '[+][0-9]{0,2} ?$' or substring(_t, greatest(1, x.start), 1) = '+'"),
        6: ("_d", "_t", _ACCOUNT, "x.word rlike '^[A-Z]{2}[0-9]{2}[A-Z0-9]{15,26}$' and x.word rlike '[0-9]{6}'"),
        7: ("_d", "_t", _SECRET, "x.word rlike '[0-9]' and x.word rlike '[A-Za-z]' and _near rlike '(?i)(token|key|secret|passw|pwd)[^A-Za-z0-9]{0,6}$'"),
    }
    out = base
    for gen, (condition, text, pattern, _) in checks.items():
        out = out.withColumn(f"_g{gen}", _where(condition, _matches(text, pattern)))
    near = "substring(_t, greatest(1, x.start - 15), least(x.start, 16))"
    count = lambda what: f"length(regexp_replace(x.word, '[^{what}]', ''))"
    assigned = ASSIGNED.replace("\\", "\\\\").replace("'", "\\'")
    parts = []
    for gen, (*_, check) in checks.items():
        features = {
            "gen": str(gen),
            "digits": _bin(_digits(), 1, 8, 10, 11, 12, 14, 16, 17, 20),
            "letters": _bin(count("A-Za-z"), 1, 6, 20),
            "gaps": _bin(count(rf" {JOIN}-"), 1, 2, 3, 4),
            "round": _bin(count("()"), 1),
            "dots": _bin(count("."), 1, 3, 4),
            "before": _char("substring(_t, x.start, if(x.start = 0, 0, 1))"),
            "after": _char("substring(_t, x.end + 1, 1)"),
            "assigned": f"int({near} rlike '{assigned}')",
            "kinds": _bin("size(array_distinct(split(x.word, '')))", 4, 8, 12),
        }
        fields = ", ".join(f"'{k}', int({v})" for k, v in features.items())
        good = f"coalesce({check.replace('_near', near)}, false)"
        parts.append(f"transform(_g{gen}, x -> named_struct('kind', {gen}, 'start', x.start, 'end', x.end, 'good', {good}, {fields}))")
    return out.withColumn("candidates", F.expr(f"case when _d then concat({', '.join(parts)}) else slice(concat({', '.join(parts)}), 1, 0) end"))


def _grow(rows: Sequence[tuple[tuple[int, ...], float, float]], score: list[float]) -> tuple:
    """One tree of two levels on rows (bins, count, passing): Newton gains of cuts 'bin < edge' or 'bin = edge'."""
    p = [1 / (1 + exp(-s)) for s in score]
    g = [r[2] - r[1] * q for r, q in zip(rows, p)]
    h = [r[1] * q * (1 - q) for r, q in zip(rows, p)]

    def best(at: list[int]) -> tuple:
        total_g, total_h = sum(g[i] for i in at), sum(h[i] for i in at)
        found = (1e-6, None)
        for f in range(len(FEATURES)):
            by: dict[int, list[float]] = {}
            for i in at:
                x = by.setdefault(rows[i][0][f], [0.0, 0.0, 0.0])
                x[0] += g[i]
                x[1] += h[i]
                x[2] += rows[i][1]
            left = [0.0, 0.0, 0.0]
            n = sum(x[2] for x in by.values())
            for value in sorted(by):
                if left[2] >= LEAST and n - left[2] >= LEAST:
                    gain = left[0] ** 2 / (left[1] + 1) + (total_g - left[0]) ** 2 / (total_h - left[1] + 1) - total_g**2 / (total_h + 1)
                    found = max(found, (gain, (f, value)), key=lambda x: x[0])
                left = [a + b for a, b in zip(left, by[value])]
        return found[1]

    def leaf(at: list[int]) -> float:
        return RATE * sum(g[i] for i in at) / (sum(h[i] for i in at) + 1)

    every = list(range(len(rows)))
    if (cut := best(every)) is None:
        return (None, leaf(every), None)
    sides = []
    for side in ([i for i in every if rows[i][0][cut[0]] < cut[1]], [i for i in every if rows[i][0][cut[0]] >= cut[1]]):
        if (under := best(side)) is None:
            sides.append((None, leaf(side), None))
        else:
            f, v = under
            sides.append((under, leaf([i for i in side if rows[i][0][f] < v]), leaf([i for i in side if rows[i][0][f] >= v])))
    return (cut, *sides)


def _value(tree, bins: tuple[int, ...]) -> float:
    while isinstance(tree, tuple):
        tree = tree[1] if tree[0] is None or bins[tree[0][0]] < tree[0][1] else tree[2]
    return tree


def _sql(tree) -> str:
    if not isinstance(tree, tuple):
        return f"{tree:.9f}D"
    return _sql(tree[1]) if tree[0] is None else f"if(x.{FEATURES[tree[0][0]]} < {tree[0][1]}, {_sql(tree[1])}, {_sql(tree[2])})"


def fit(found: DataFrame) -> tuple[str, dict[int, float]]:
    """(SQL of the score of a candidate x, least score by kind) from a written table with a column candidates."""
    each = found.where("size(candidates) > 0").select(F.pmod(F.xxhash64(F.col("candidates")), F.lit(2)).cast("int").alias("half"), F.explode("candidates").alias("x"))
    names = [f"x.{f}" for f in FEATURES]
    table = each.groupBy("half", *names).agg(F.count("*").alias("n"), F.sum(F.col("x.good").cast("int")).alias("good"))
    got = [tuple(r) for r in table.orderBy("half", *FEATURES).collect()]  # a row a combination of bins
    halves = [[(r[1:-2], float(r[-2]), float(r[-1])) for r in got if r[0] == k] for k in (0, 1)]
    if not halves[0]:
        return "-99D", {}
    n, good = (sum(r[k] for r in halves[0]) for k in (1, 2))
    start = log((good + 1) / (n - good + 1))
    score, trees = [start] * len(halves[0]), []
    for _ in range(TREES):
        trees.append(_grow(halves[0], score))
        score = [s + _value(trees[-1], r[0]) for s, r in zip(score, halves[0])]
    least: dict[int, float] = {}
    for kind in {r[0][0] for r in halves[1]}:
        own = sorted(((start + sum(_value(t, b) for t in trees), n, k) for b, n, k in halves[1] if b[0] == kind), key=lambda x: -x[0])
        n = good = 0.0
        for i, (s, a, b) in enumerate(own):
            n, good = n + a, good + b
            if (i + 1 == len(own) or own[i + 1][0] < s) and good >= PRECISION * n and n >= LEAST:
                least[kind] = s
    return f"({start:.9f}D" + "".join(f" + {_sql(t)}" for t in trees) + ")", least


def chosen(found: DataFrame, model: tuple[str, dict[int, float]]) -> DataFrame:
    """found with a column spans: kind (place in KINDS), start, end of base spans and added ones, by start, then kind."""
    score, least = model
    base = "concat(" + ", ".join(f"transform({k}, x -> named_struct('start', x.start, 'kind', {i}, 'end', x.end))" for i, k in enumerate(BASE)) + ")"
    limit = " ".join(f"when {k} then {s - 1e-7:.9f}D" for k, s in sorted(least.items()))
    passing = f"filter(candidates, x -> {score} >= case x.kind {limit} else 1e9D end)" if least else "slice(candidates, 1, 0)"
    out = found.withColumn("_base", F.expr(f"array_sort({base})"))
    out = out.withColumn("_more", F.expr(f"filter({passing}, x -> not exists(_base, b -> b.start < x.end and x.start < b.end))"))
    ordered = "array_sort(transform(_more, x -> named_struct('start', x.start, 'kind', x.kind, 'end', x.end)))"
    greedy = _folded(ordered, "struct<start: int, kind: int, end: int>", "if(x.start >= a.at, named_struct('at', x.end, 'odd', a.odd, 'out', array_append(a.out, x)), a)")
    return out.withColumn("spans", F.expr(f"case when size(_more) = 0 then _base else array_sort(concat(_base, {greedy})) end"))


def joined(spans: str) -> Column:
    """kind:start:end of spans, comma-joined."""
    names = ", ".join(f"'{k}'" for k in KINDS)
    return F.expr(f"array_join(transform({spans}, x -> concat_ws(':', element_at(array({names}), x.kind + 1), string(x.start), string(x.end))), ',')")


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, email, ip, card, phone (base spans), _base and spans (kind, start, end) of each row."""
    own = docs.select(F.col(id_col), F.col(text_col))
    found = written(candidates(base_spans(own, text_col)).select(id_col, *BASE, "candidates"), "candidates")
    return chosen(found, fit(found))


def redacted(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """docs, with all their columns, where every chosen span of the text is replaced by its kind in brackets; null texts stay null."""
    columns = docs.columns
    row = docs.select(F.struct(*[docs[c] for c in columns]).alias("_row"), F.col(text_col).alias("_text"))
    fitted = fit(written(candidates(base_spans(row, "_text")).select("candidates"), "candidates"))
    names = ", ".join(f"'[{k}]'" for k in KINDS)
    step = f"""if(x.start < a.at, a, named_struct('at', x.end, 'odd', a.odd, 'out',
        concat(a.out, array(substring(_text, a.at + 1, x.start - a.at), element_at(array({names}), x.kind + 1)))))"""
    new = F.expr(_folded("spans", "string", step, "s -> concat(array_join(flatten(s.out), ''), substring(_text, s.at + 1))"))
    out = chosen(candidates(base_spans(row, "_text")), fitted).withColumn("_new", F.when(F.expr("size(spans) = 0"), F.col("_text")).otherwise(new))
    return out.select(*[F.col("_new").alias(c) if c == text_col else F.col("_row")[c].alias(c) for c in columns])
