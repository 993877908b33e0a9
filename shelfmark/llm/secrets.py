"""Secret scans, with DataFrame functions only: base patterns and a randomness test battery.

Base: matches of three patterns, leftmost and not overlapping within a kind. A match's place is the sum of the lengths
of what stands before it: the gaps between matches (split) and the matches themselves.

Battery: every run of at least ``LEAST`` characters of the base64 alphabets is a candidate, if its characters fit an
encoding that was inferred from them (hex, base32, lower-case or mixed letters and digits, base64). So are the pieces of
a run (``PIECES``): the longest ones without equals signs, of either base64 alphabet, and of letters and digits alone
(name=value, paths, mixed separators).

First a candidate must pass for random symbols of its encoding: chi-squared of uniformity over the whole alphabet, the number of
runs of symbols of one kind (capital, small letter, digit, sign), and the serial correlation at lag one of the symbols' places
in the alphabet are standardised by their exact or asymptotic moments for its length, and the sum of their squares (of chi-squared
only where it is above its mean) may not exceed ``DEPARTURE``, which random symbols do about once in a hundred times. Repeated and
ascending strings, paths with many slashes and most names put together end here.

Then three statistics tell random symbols from ordinary ones:

- chi-squared of uniformity over the alphabet, its symbols pooled into cells that are expected often enough: digits and
  signs, capitals, and the letters that are frequent or rare in ordinary text;
- the number of runs of symbols of one kind (capital, small letter, digit, sign);
- the serial correlation at lag one of the vowels, which alternate in ordinary text.

The hypothesis is that a candidate is ordinary: words put together, with some capitals, digits and signs. Under it
the statistics' distributions follow from fixed shares (``ENCODINGS``) in closed form: the root of chi-squared is about
normal around sqrt(c0 + c1 n - v / c1) with a constant deviation, the others are about normal too; deviations are widened
by ``WIDER``, as words differ. Each test's p-value says how likely ordinary symbols look as random as these; Fisher's
method combines the three. Within each class of lengths, apart for runs and for pieces, Benjamini-Hochberg at level
``FDR`` takes the discoveries over the whole corpus: these are the secrets of kind rand, so the expected share of ordinary
candidates among them is what is controlled. What base matches cover is left to them, and a piece within a longer discovery
is part of it. For the step-up rule p-values are rounded up to powers of exp(-1/8), so that it needs only counts by length
class and power: a table of bounded size, the only thing that is shuffled or broadcast. All statistics are counts of
characters and patterns, in time proportional to a candidate's length.

Nulls and edges: a null text is empty; an empty text has no spans (their digest is that of the empty string); a null
doc_id is passed on; repeated rows give repeated rows, and count as often in the step-up rule; an empty table gives an
empty result; other columns are not read, and pass through redaction as they are.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfmark.llm._session import table, written

#: The base patterns. The first character is looked at before the words are tried.
ASSIGN = r"""(?=[PpSsTtAa])(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
VALUE = 12
#: Kinds in their order; rand is the battery's.
KINDS = ("assign", "access", "hex", "rand")

LEAST = 20
RUN = rf"[A-Za-z0-9+/_=-]{{{LEAST},}}"
PIECES = tuple(rf"[{x}]{{{LEAST},}}" for x in ("A-Za-z0-9+/_-", "A-Za-z0-9+/", "A-Za-z0-9_-", "A-Za-z0-9"))
FDR = 0.05
#: Upper ends of the length classes.
LENGTHS = (24, 32, 48, 64, 128)
#: p-values are told apart down to exp(-LEVELS / 8).
LEVELS = 400
#: Deviations under the hypothesis, as a multiple of those of independent symbols.
WIDER = 1.25
#: How far a candidate's three statistics may be from those of random symbols: the 99.4 % point of chi-squared with three degrees.
DEPARTURE = 12.5

_UPPER, _LOWER, _DIGITS, _SIGNS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789", "+/-_"
_ALL = _UPPER + _LOWER + _DIGITS + _SIGNS
_KINDS = "U" * 26 + "L" * 26 + "D" * 10 + "S" * 4
_VOWELS = "".join("V" if c in "AEIOUaeiou" else "C" for c in _ALL)
#: The letters that are most frequent in ordinary text.
_FREQUENT = "etaoinsr"


class Encoding:
    """An alphabet with what a run must show to be of it, and what ordinary runs of it look like: cells of symbols with
    their shares, how often the kind changes from one symbol to the next, and the vowels' serial correlation."""

    def __init__(self, shape: str, cells: tuple[tuple[str, float], ...], changes: float, vowels: float):
        self.shape, self.cells, self.changes, self.vowels = shape, cells, changes, vowels
        size = sum(len(symbols) for symbols, _ in cells)
        self.shares = [len(symbols) / size for symbols, _ in cells]
        q, u = [share for _, share in cells], self.shares
        self.c0 = sum(x * (1 - x) / y for x, y in zip(q, u, strict=True))
        self.c1 = sum((x - y) ** 2 / y for x, y in zip(q, u, strict=True))
        spread = sum(x * ((x - y) / y) ** 2 for x, y in zip(q, u, strict=True)) - self.c1**2
        self.c2 = spread / self.c1
        self.deviation = WIDER * math.sqrt(self.c2)
        self.symbols = "".join(symbols for symbols, _ in cells)
        self.names = "".join(chr(97 + i) * len(symbols) for i, (symbols, _) in enumerate(cells))
        self.alphabet = "".join(c for c in _ALL if c in self.symbols)
        kinds = [_KINDS[_ALL.index(c)] for c in self.alphabet]
        #: How often the kind changes among random symbols.
        self.random_changes = 1 - sum((kinds.count(k) / size) ** 2 for k in set(kinds))


def _one_case(letters: str, digits: str) -> tuple[tuple[str, float], ...]:
    often = "".join(c for c in letters if c.lower() in _FREQUENT)
    return (digits, 0.1), (often, 0.56), ("".join(c for c in letters if c not in often), 0.34)


def _two_cases(signs: str) -> tuple[tuple[str, float], ...]:
    (_, _), (often, _), (rare, _) = _one_case(_LOWER, _DIGITS)
    return (_DIGITS + signs, 0.08), (_UPPER, 0.12), (often, 0.5), (rare, 0.3)


def _hex(letters: str) -> tuple[tuple[str, float], ...]:
    return ("0", 0.25), ("123456789", 0.5), (letters, 0.25)


#: In the order in which they are tried.
ENCODINGS = (
    Encoding(r"^(?=.*[a-f])(?=.*[0-9])[0-9a-f]+$", _hex("abcdef"), 0.25, 0.0),
    Encoding(r"^(?=.*[A-F])(?=.*[0-9])[0-9A-F]+$", _hex("ABCDEF"), 0.25, 0.0),
    Encoding(r"^(?=.*[A-Z])(?=.*[2-7])[A-Z2-7]+=*$", _one_case(_UPPER, "234567"), 0.12, -0.3),
    Encoding(r"^(?=.*[a-z])(?=.*[0-9].*[0-9])[a-z0-9]+$", _one_case(_LOWER, _DIGITS), 0.12, -0.3),
    Encoding(r"^(?=.*[A-Z])(?=.*[0-9].*[0-9])[A-Z0-9]+$", _one_case(_UPPER, _DIGITS), 0.12, -0.3),
    Encoding(r"^(?=.*[A-Z])(?=.*[a-z])(?=.*[0-9])[A-Za-z0-9]+$", _two_cases(""), 0.25, -0.3),
    Encoding(r"^(?=.*[A-Z])(?=.*[a-z])(?=.*[0-9])[A-Za-z0-9+/]+=*$", _two_cases("+/"), 0.25, -0.3),
    Encoding(r"^(?=.*[A-Z])(?=.*[a-z])(?=.*[0-9])[A-Za-z0-9_-]+=*$", _two_cases("-_"), 0.25, -0.3),
)


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with value computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def using(value: str, name: str, sql: str) -> str:
    """SQL: the expression, with value computed once under a name."""
    return f"element_at(transform(array({value}), {name} -> {sql}), 1)"


def running(numbers: str, first: str, add: str) -> str:
    """SQL: what add gives for each number and all before it; by blocks, so that long arrays cost n sqrt(n)."""
    over = lambda part: f"aggregate({part}, {first}, (a, y) -> {add})"
    whole = f"transform(sequence(0, int(size(x) / w)), b -> {over('slice(x, b * w + 1, w)')})"
    before = using(whole, "s", f"transform(sequence(0, size(s) - 1), b -> {over('slice(s, 1, b)')})")
    each = f"transform(x, (y, i) -> {over('array(t[int(i / w)], ' + over('slice(x, int(i / w) * w + 1, i % w + 1)') + ')')})"
    return using(numbers, "x", using("greatest(8, int(ceil(sqrt(size(x)))))", "w", using(before, "t", each)))


def quoted(text: str) -> str:
    """As a string of Spark SQL."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def places(found: str, pattern: str, order: int, keep: str = "true") -> str:
    """SQL: the matches in a column as structs (start, kind, end, value), of those that keep accepts (of value m)."""
    gaps = f"transform(slice(split(_text, {quoted(pattern)}, -1), 1, size({found})), g -> bigint(length(g)))"
    ends = running(f"zip_with({gaps}, transform({found}, m -> bigint(length(m))), (g, m) -> g + m)", "0L", "a + y")
    out = f"zip_with({found}, {ends}, (m, e) -> struct(e - length(m) start, {order} kind, e end, m value))"
    return f"CASE WHEN size({found}) > 0 THEN filter({out}, s -> {using('s.value', 'm', keep)}) ELSE cast(array() as array<struct<start:bigint,kind:int,end:bigint,value:string>>) END"


def with_base_spans(docs: DataFrame) -> DataFrame:
    """Adds _base: the base matches of each text; and _runs: the battery's candidates, with p-values."""
    columns = {f"_m{i}": F.regexp_extract_all("_text", F.lit(pattern), F.lit(0)) for i, pattern in enumerate((ASSIGN, ACCESS, HEX, RUN))}
    found = docs.withColumn("_text", F.coalesce("text", F.lit(""))).withColumns(columns)
    # Pieces have kinds from 4 on; only runs with separators have any of their own.
    cut, none = F.exists("_m3", lambda m: m.rlike("[+/_=-]")), F.array().cast("array<string>")
    found = found.withColumns({f"_m{4 + i}": F.when(cut, F.regexp_extract_all("_text", F.lit(p), F.lit(0))).otherwise(none) for i, p in enumerate(PIECES)})
    mixed = "m rlike '[0-9]' and m rlike '[A-Za-z]'"
    keep = (f"length(regexp_extract(m, {quoted(ASSIGN)}, 1)) >= {VALUE}", "true", "true", *[mixed] * (1 + len(PIECES)))
    each = [places(f"_m{i}", pattern, i, keep[i]) for i, pattern in enumerate((ASSIGN, ACCESS, HEX, RUN, *PIECES))]
    ordered = f"array_sort(transform(concat({', '.join(each[3:])}), s -> struct(s.start start, s.end end, s.kind kind, s.value value)))"
    first = using(ordered, "x", "filter(x, (s, i) -> i = 0 or x[i - 1].start <> s.start or x[i - 1].end <> s.end)")
    tested = f"filter(transform({first}, s -> struct(s.start start, s.kind kind, s.end end, {battery('s.value')} p)), s -> s.p is not null)"
    found = found.withColumns({"_base": F.expr(f"array_sort(concat({', '.join(each[:3])}))"), "_runs": F.expr(tested)})
    return found.drop("_text", *(f"_m{i}" for i in range(4 + len(PIECES))))


def battery(value: str) -> str:
    """SQL: the combined p-value of a run under its inferred encoding; null without one."""
    return "CASE " + " ".join(f"WHEN {value} rlike '{e.shape}' THEN {using(f"rtrim('=', {value})", 'body', f'CASE WHEN {departure(e)} <= {DEPARTURE}D THEN {combined(e)} END')}" for e in ENCODINGS) + " END"


def departure(e: Encoding) -> str:
    """SQL: the sum of squares of how far body is from random symbols of the encoding; see above."""
    d, change = len(e.alphabet), e.random_changes
    add = lambda numbers, value="y": f"aggregate({numbers}, 0D, (a, y) -> a + {value})"
    counts = add("transform(array_distinct(q.chars), k -> pow(double(length(body) - length(replace(body, k, ''))), 2))")
    chi = f"greatest(0D, ({d}D / q.n * {counts} - q.n - {d - 1}D) / sqrt({2 * (d - 1)}D * (q.n - 1) / q.n))"
    runs = f"({CHANGES.format('q.kinds')} - {change!r}D * (q.n - 1)) / sqrt({change * (1 - change)!r}D * (q.n - 1))"
    products = add("zip_with(slice(x, 1, size(x) - 1), slice(x, 2, size(x) - 1), (f, g) -> f * g)")
    sums = f"struct({add('x')} s, {add('x', 'y * y')} ss, {products} p, x[0] + x[size(x) - 1] ends)"
    above = "(v.p - v.s / q.n * (2 * v.s - v.ends) + (q.n - 1) * (v.s / q.n) * (v.s / q.n))"
    serial_ = using(f"transform(q.chars, k -> double(locate(k, '{e.alphabet}')))", "x", using(sums, "v", f"CASE WHEN v.ss * q.n - v.s * v.s > 0 THEN {above} / (v.ss - v.s * v.s / q.n) * sqrt(q.n) ELSE sqrt(q.n) END"))
    held = f"struct(regexp_extract_all(body, '.', 0) chars, double(length(body)) n, translate(body, '{_ALL}', '{_KINDS}') kinds)"
    return using(held, "q", f"pow({chi}, 2) + pow({runs}, 2) + pow({serial_}, 2)")


def combined(e: Encoding) -> str:
    """SQL: Fisher's method over the three tests of body; chi-squared with 6 degrees of freedom has a closed form."""
    images = f"translate(body, '{e.symbols}', '{e.names}') cells, translate(body, '{_ALL}', '{_KINDS}') kinds, translate(body, '{_ALL}', '{_VOWELS}') vowels"
    deviates = f"array({uniformity(e)}, {runs_test(e)}, {serial(e)})"
    half = f"-aggregate(transform({deviates}, z -> ln({using('greatest(-8D, least(8D, z))', 'c', BEYOND)})), 0D, (a, x) -> a + x)"
    return using(f"struct({images}, double(length(body)) n)", "m", using(half, "h", "least(1D, exp(-h) * (1 + h + h * h / 2))"))


#: SQL: the normal tail above c; a logistic form that errs by less than 0.0002.
BEYOND = "1 / (1 + exp(1.5976D * c + 0.07056D * c * c * c))"


def uniformity(e: Encoding) -> str:
    """SQL: by how many deviations the root of chi-squared is below that of ordinary symbols."""
    held = [f"(m.n - length(replace(m.cells, '{chr(97 + i)}', '')))" for i in range(len(e.shares))]
    root = " + ".join(f"pow({x} - m.n * {u!r}D, 2) / (m.n * {u!r}D)" for x, u in zip(held, e.shares, strict=True))
    return f"(sqrt(greatest(0D, {e.c0!r}D + {e.c1!r}D * m.n - {e.c2!r}D)) - sqrt({root})) / {e.deviation!r}D"


CHANGES = "regexp_count({}, 'U(?=[LDS])|L(?=[UDS])|D(?=[ULS])|S(?=[ULD])')"


def runs_test(e: Encoding) -> str:
    """SQL: by how many deviations there are more runs."""
    return f"({CHANGES.format('m.kinds')} - {e.changes}D * (m.n - 1) - 0.5D) / ({WIDER}D * sqrt({e.changes * (1 - e.changes)!r}D * (m.n - 1)))"


def serial(e: Encoding) -> str:
    """SQL: by how many deviations the serial correlation of x = 1 for vowels, 0 for others, is higher; from the number of
    vowels, of their runs, and the first and last symbol."""
    counts = "double(length(replace(m.vowels, 'C', ''))) ones, regexp_count(m.vowels, 'V+') runs, double(int(m.vowels like 'V%')) + double(int(m.vowels like '%V')) ends"
    share = "v.ones / m.n"
    r = f"(v.ones - v.runs - {share} * (2 * v.ones - v.ends) + (m.n - 1) * ({share}) * ({share})) / (v.ones * (1 - {share}))"
    r = using(f"struct({counts})", "v", f"CASE WHEN v.ones = 0 OR v.ones = m.n THEN 0D ELSE {r} END")
    return f"({r} - {e.vowels}D) * sqrt(m.n) / {WIDER}D"


def length_class(span: Column) -> Column:
    """Of a run; those of pieces come after."""
    out = F.lit(len(LENGTHS))
    for i, end in reversed(list(enumerate(LENGTHS))):
        out = F.when(span["end"] - span["start"] <= end, i).otherwise(out)
    return out + F.when(span["kind"] > 3, len(LENGTHS) + 1).otherwise(0)


def level(p: Column) -> Column:
    """p is at most exp(-level / 8)."""
    return F.least(F.lit(LEVELS), F.floor(-F.log(F.greatest(p, F.lit(1e-30))) * 8)).cast("int")


def discovered_from(runs: DataFrame) -> DataFrame:
    """class, least: the level from which Benjamini-Hochberg discovers secrets; of (class, level) rows with counts.

    At most 2 * (len(LENGTHS) + 1) * (LEVELS + 1) rows.
    """
    counts = runs.select(F.explode("_runs").alias("s")).groupBy(length_class(F.col("s")).alias("class"), level(F.col("s.p")).alias("level")).agg(F.count("*").alias("n"))
    down = Window.partitionBy("class").orderBy(F.desc("level"))
    ranked = counts.withColumn("k", F.sum("n").over(down)).withColumn("m", F.sum("n").over(Window.partitionBy("class")))
    return ranked.filter(F.exp(-F.col("level") / 8) * F.col("m") <= FDR * F.col("k")).groupBy("class").agg(F.min("level").alias("least"))


def with_spans(spanned: DataFrame, limits: DataFrame) -> DataFrame:
    """Adds _spans: base matches and, of the candidates that are discoveries, what these don't cover.

    limits has a row for each length class at most, and goes into the expression.
    """
    limit = {r["class"]: r.least for r in limits.collect()}
    least = F.array(*(F.lit(limit.get(i, LEVELS + 1)) for i in range(2 * (len(LENGTHS) + 1))))
    passes = lambda s: level(s["p"]) >= F.get(least, length_class(s))
    place = lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))
    within = lambda s, o: (o["kind"] < s["kind"]) & (o["start"] <= s["start"]) & (s["end"] <= o["end"])
    rand = lambda a, b: F.array(F.struct(a.alias("start"), F.lit(3).alias("kind"), b.alias("end")))
    none = F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>")

    def uncovered(s: Column) -> Column:
        """The parts of s beside the base matches, which are in the order of their starts."""
        met = F.filter("_base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))
        step = lambda a, b: F.struct(F.greatest(a["at"], b["end"]).alias("at"), F.when(b["start"] > a["at"], F.concat(a["out"], rand(a["at"], b["start"]))).otherwise(a["out"]).alias("out"))
        return F.aggregate(met, F.struct(s["start"].alias("at"), none.alias("out")), step, lambda a: F.when(a["at"] < s["end"], F.concat(a["out"], rand(a["at"], s["end"]))).otherwise(a["out"]))

    more = let(F.filter("_runs", passes), lambda x: F.filter(x, lambda s: ~F.exists(x, lambda o: within(s, o))))
    rest = F.array_distinct(F.flatten(F.transform(more, uncovered)))
    return spanned.withColumn("_spans", F.array_sort(F.concat(F.transform("_base", place), rest)))


def listed(spans: Column) -> Column:
    name = lambda s: F.element_at(F.array(*map(F.lit, KINDS)), s["kind"] + 1)
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", name(s), s["start"].cast("string"), s["end"].cast("string"))), ",")


def find_secrets(docs: DataFrame) -> DataFrame:
    """doc_id, the number of each base kind, the digest of the base spans, and all spans."""
    found = with_base_spans(docs.select(F.col("doc_id").cast("long"), "text")).select("doc_id", "_base", "_runs")
    found = written(found, "secret-spans")
    spanned = with_spans(found, discovered_from(found))
    count = lambda kind: F.size(F.filter("_base", lambda s: s["kind"] == kind)).cast("long")
    return spanned.select(
        "doc_id", *(count(i).alias(f"n_{name}") for i, name in enumerate(KINDS[:3])), F.sha2(listed(F.col("_base")).cast("binary"), 256).alias("base_sha256"), listed(F.col("_spans")).alias("spans")
    )


def redact_secrets(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """The documents with every span replaced by a mark, and n_chars to match; columns as they were."""
    own = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row"), "text")  # apart from our columns
    found = written(with_base_spans(own).drop("text"), "secret-spans").withColumn("_whole", F.col("_row").getField("text"))  # written once
    spanned = with_spans(found, discovered_from(found.select("_runs")))
    # Spans that overlap are one; the pieces between them are joined by marks. A span begins one where it starts at or
    # beyond all ends before it, and what ends last before the next such span ends it.
    reach = F.col("_reach")
    begins = F.filter(F.sequence(F.lit(0), F.size("_spans") - 1), lambda i: (i == 0) | (F.get("_spans", i)["start"] >= F.get(reach, i - 1)))
    merged = spanned.withColumn("_reach", F.expr(running("transform(_spans, s -> s.end)", "-1L", "greatest(a, y)"))).withColumn("_begins", F.when(F.size("_spans") > 0, begins).otherwise(F.array().cast("array<int>")))
    last = lambda j: F.coalesce(F.get("_begins", j + 1), F.size("_spans")) - 1
    merged = merged.withColumn("_merged", F.transform("_begins", lambda i, j: F.struct(F.get("_spans", i)["start"].alias("start"), F.get(reach, last(j)).alias("end"))))
    starts = F.concat(F.array(F.lit(0).cast("long")), F.transform("_merged", lambda s: s["end"]))
    ends = F.concat(F.transform("_merged", lambda s: s["start"]), F.array(F.length("_whole").cast("long")))
    pieces = F.zip_with(starts, ends, lambda a, b: F.substr(F.col("_whole"), (a + 1).cast("int"), (b - a).cast("int")))
    # A select of its own: within a lambda, a name that the same select gives to a column would mean that column.
    merged = merged.withColumn("_text", F.when(F.size("_merged") > 0, F.array_join(pieces, mark)).otherwise(F.col("_whole")))
    changed = {"text": F.col("_text")}
    if "n_chars" in docs.columns:
        old = F.col("_row").getField("n_chars")
        changed["n_chars"] = F.when(F.size("_merged") > 0, F.length("_text").cast(docs.schema["n_chars"].dataType)).otherwise(old)
    return merged.select(*(changed.get(c, F.col("_row").getField(c)).alias(c) for c in docs.columns))


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_secrets(table(spark, sf_dir, "documents"))


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def oracle() -> str:
    """The same in DuckDB, whose patterns have no look-ahead: cases are spelled out, shapes are conditions."""
    cased = lambda word: "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)
    words = "|".join([*map(cased, ("password", "passwd", "secret", "token")), cased("api") + "_?" + cased("key")])
    assign = rf"""(?:{words})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    patterns = (assign, r"AKIA[A-Z0-9]+", r"[0-9a-f]+", RUN, *PIECES)
    mixed = "regexp_matches(m, '[0-9]') AND regexp_matches(m, '[A-Za-z]')"
    keep = (f"length(regexp_extract(m, {_quoted(assign)}, 1)) >= {VALUE}", "length(m) >= 18", "length(m) >= 16", *[mixed] * (1 + len(PIECES)))
    found = " UNION ALL ".join(
        f"""SELECT r, {i} AS kind, e - length(m) AS a, e, m FROM (SELECT r, unnest(ms) AS m,
  unnest(list_transform(range(1, len(ms) + 1), lambda j: list_sum(list_transform(gs[1:j], lambda g: length(g))) + list_sum(list_transform(ms[1:j], lambda g: length(g))))) AS e
  FROM (SELECT r, regexp_extract_all(t, {_quoted(p)}, 0) AS ms, string_split_regex(t, {_quoted(p)}) AS gs FROM doc)) WHERE {keep[i]}"""
        for i, p in enumerate(patterns)
    )
    need = lambda m, *classes: " AND ".join(f"regexp_matches(m, '{c}')" for c in (m, *classes))
    shapes = (
        need("^[0-9a-f]+$", "[a-f]", "[0-9]"), need("^[0-9A-F]+$", "[A-F]", "[0-9]"), need("^[A-Z2-7]+=*$", "[A-Z]", "[2-7]"), need("^[a-z0-9]+$", "[a-z]", "[0-9].*[0-9]"),
        need("^[A-Z0-9]+$", "[A-Z]", "[0-9].*[0-9]"), need("^[A-Za-z0-9]+$", "[A-Z]", "[a-z]", "[0-9]"), need("^[A-Za-z0-9+/]+=*$", "[A-Z]", "[a-z]", "[0-9]"), need("^[A-Za-z0-9_-]+=*$", "[A-Z]", "[a-z]", "[0-9]"),
    )
    which = "CASE " + " ".join(f"WHEN {s} THEN {i}" for i, s in enumerate(shapes)) + " END"
    cell = lambda i: f"(length(cells) - length(replace(cells, '{chr(97 + i)}', '')))"
    chi = lambda e: "sqrt(" + " + ".join(f"power({cell(i)} - n * {u!r}::DOUBLE, 2) / (n * {u!r}::DOUBLE)" for i, u in enumerate(e.shares)) + ")"
    of = lambda use: "CASE enc " + " ".join(f"WHEN {i} THEN {use(e)}" for i, e in enumerate(ENCODINGS)) + " END"
    pairs = " + ".join(f"(length(kinds) - length(replace(kinds, '{x}{y}', ''))) // 2" for x in "ULDS" for y in "ULDS" if x != y)
    tail = lambda z: f"1 / (1 + exp(1.5976 * {z} + 0.07056 * {z} * {z} * {z}))"
    bounded = lambda z: f"greatest(-8.0::DOUBLE, least(8.0::DOUBLE, {z}))"
    lengths = "CASE " + " ".join(f"WHEN e - a <= {n} THEN {i}" for i, n in enumerate(LENGTHS)) + f" ELSE {len(LENGTHS)} END + CASE WHEN kind > 3 THEN {len(LENGTHS) + 1} ELSE 0 END"
    names = "CASE kind " + " ".join(f"WHEN {i} THEN '{x}'" for i, x in enumerate(KINDS)) + " END"
    one_of = ", ".join(f"({i}, '{e.symbols}', '{e.names}', '{e.alphabet}', {e.random_changes!r}::DOUBLE)" for i, e in enumerate(ENCODINGS))
    d = "length(alphabet)::DOUBLE"
    return f"""
WITH doc AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
hit AS ({found}),
one AS (SELECT * FROM hit WHERE kind > 2 QUALIFY row_number() OVER (PARTITION BY r, a, e ORDER BY kind) = 1),
encoding(enc, symbols, names, alphabet, chg) AS (VALUES {one_of}),
run AS (SELECT row_number() OVER () AS id, r, kind, a, e, rtrim(m, '=') AS body, {which} AS enc FROM one),
img AS (SELECT id, r, kind, a, e, enc, length(body)::DOUBLE AS n, translate(body, symbols, names) AS cells, translate(body, '{_ALL}', '{_KINDS}') AS kinds, translate(body, '{_ALL}', '{_VOWELS}') AS vowels,
    string_split(body, '') AS chars, list_transform(string_split(body, ''), lambda c: strpos(alphabet, c)::DOUBLE) AS x, body, alphabet, chg FROM run JOIN encoding USING (enc)),
sum1 AS (SELECT *, ({pairs})::DOUBLE AS kc, list_sum(list_transform(list_distinct(chars), lambda k: power(length(body) - length(replace(body, k, '')), 2)))::DOUBLE AS sq, list_sum(x) AS s,
  list_sum(list_transform(x, lambda y: y * y)) AS ss, list_sum(list_transform(range(1, len(x)), lambda i: x[i] * x[i + 1])) AS p, x[1] + x[-1] AS xe FROM img),
fit AS (SELECT * FROM sum1 WHERE power(greatest(0, ({d} / n * sq - n - ({d} - 1)) / sqrt(2 * ({d} - 1) * (n - 1) / n)), 2) + power((kc - chg * (n - 1)) / sqrt(chg * (1 - chg) * (n - 1)), 2)
  + power(CASE WHEN ss * n - s * s > 0 THEN (p - s / n * (2 * s - xe) + (n - 1) * (s / n) * (s / n)) / (ss - s * s / n) * sqrt(n) ELSE sqrt(n) END, 2) <= {DEPARTURE}),
cnt AS (SELECT *, {of(chi)} AS root, ({pairs})::DOUBLE AS ch, length(replace(vowels, 'C', ''))::DOUBLE AS ones, len(regexp_extract_all(vowels, 'V+')) AS vr,
  (vowels[1] = 'V')::INT::DOUBLE + (vowels[-1] = 'V')::INT::DOUBLE AS ends FROM fit),
stat AS (SELECT *, CASE WHEN ones = 0 OR ones = n THEN 0.0 ELSE (ones - vr - ones / n * (2 * ones - ends) + (n - 1) * (ones / n) * (ones / n)) / (ones * (1 - ones / n)) END AS corr FROM cnt),
zed AS (SELECT *, {bounded(of(lambda e: f"((sqrt(greatest(0.0::DOUBLE, {e.c0!r}::DOUBLE + {e.c1!r}::DOUBLE * n - {e.c2!r}::DOUBLE)) - root) / {e.deviation!r}::DOUBLE)"))} AS z1,
  {bounded(of(lambda e: f"((ch - {e.changes} * (n - 1) - 0.5) / ({WIDER} * sqrt({e.changes * (1 - e.changes)!r}::DOUBLE * (n - 1))))"))} AS z2,
  {bounded(of(lambda e: f"((corr - {e.vowels}) * sqrt(n) / {WIDER})"))} AS z3 FROM stat),
comb AS (SELECT *, -(ln({tail("z1")}) + ln({tail("z2")}) + ln({tail("z3")})) AS h FROM zed),
tested AS (SELECT *, {lengths} AS cls, least({LEVELS}, floor(-ln(greatest(least(1.0::DOUBLE, exp(-h) * (1 + h + h * h / 2)), 1e-30)) * 8))::INT AS lvl FROM comb),
num AS (SELECT cls, lvl, count(*) AS c FROM tested GROUP BY ALL),
step AS (SELECT *, sum(c) OVER (PARTITION BY cls ORDER BY lvl DESC) AS k, sum(c) OVER (PARTITION BY cls) AS m FROM num),
least_level AS (SELECT cls, min(lvl) AS lim FROM step WHERE exp(-lvl / 8) * m <= {FDR} * k GROUP BY cls),
pass AS (SELECT id, r, kind, a, e FROM tested JOIN least_level USING (cls) WHERE lvl >= lim),
longest AS (SELECT * FROM pass p WHERE NOT EXISTS (SELECT 1 FROM pass o WHERE o.r = p.r AND o.kind < p.kind AND o.a <= p.a AND p.e <= o.e)),
met AS (SELECT t.id, t.r, t.a AS sa, t.e AS se, b.a, b.kind, b.e FROM longest t JOIN hit b ON b.kind < 3 AND b.r = t.r AND b.a < t.e AND t.a < b.e),
gap AS (SELECT *, greatest(sa, coalesce(max(e) OVER (PARTITION BY id ORDER BY a, kind ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), sa)) AS free FROM met),
rest AS (SELECT r, free AS a, a AS e FROM gap WHERE a > free UNION SELECT r, greatest(sa, max(e)), se FROM met GROUP BY id, r, sa, se HAVING greatest(sa, max(e)) < se
  UNION SELECT r, a, e FROM longest WHERE id NOT IN (SELECT id FROM met)),
span AS (SELECT r, kind, a, e FROM hit WHERE kind < 3 UNION ALL SELECT r, 3, a, e FROM rest),
listed AS (SELECT r, count_if(kind = 0) AS c0, count_if(kind = 1) AS c1, count_if(kind = 2) AS c2,
  string_agg({names} || ':' || a || ':' || e, ',' ORDER BY a, kind, e) FILTER (WHERE kind < 3) AS base, string_agg({names} || ':' || a || ':' || e, ',' ORDER BY a, kind, e) AS spans FROM span GROUP BY r)
SELECT doc_id, coalesce(c0, 0)::BIGINT AS n_assign, coalesce(c1, 0)::BIGINT AS n_access, coalesce(c2, 0)::BIGINT AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM doc LEFT JOIN listed USING (r)
"""
