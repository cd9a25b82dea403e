"""Secret scan: three base patterns and a battery of randomness tests, in column expressions only.

Other long tokens are candidates. Each gets an inferred encoding and, under the
hypothesis that its symbols are uniform, a chi-squared test of the alphabet, a
runs test about the middle of the alphabet and a test of serial correlation. A
candidate is random when none of them rejects (Bonferroni) and when text-like strings
are rarely like it: far less even, or of other letters. How often text-like strings
have a letter is counted over the long words of the input. The second p-value is
weighted by length and held to a false-discovery rate over all candidates of the
input (weighted Benjamini-Hochberg over a histogram).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from vocatio.llm.tables import stored

# Kinds in their order, pattern, least characters and the group they count.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
LEAST = {"assign": 6, "access": 20, "hex": 24}
KINDS = ["assign", "access", "hex", "random"]

# Maximal runs that are long enough; equal to dropping the short matches of the open pattern.
LONG_ACCESS = r"AKIA[A-Z0-9]{16,}"
LONG_HEX = r"[0-9a-f]{24,}"
CANDIDATE = r"[A-Za-z0-9+/_-]{16,}"
# Candidates that are text for certain: words, alone or joined. Their letters are counted.
WORDS = "^([A-Z]?[a-z]+|[A-Z]+)([/_-]([A-Z]?[a-z]+|[A-Z]+))*$"

RATE = 0.01  # false-discovery rate of added spans
REJECT = 0.001  # level of the uniformity battery
TEXT_LIKE = 1.7  # text-like strings repeat symbols at least so much more often than uniform ones
BINS = 400  # of twentieths of a decimal order of p-value

DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# Encodings from the narrowest; digits alone and letters of one case are numbers and words.
ENCODINGS = [
    ("^[0-9]+$", None), ("^[a-z]+$", None), ("^[A-Z]+$", None),
    ("^[0-9a-f]+$", DIGITS + "abcdef"), ("^[0-9A-F]+$", DIGITS + "ABCDEF"),
    ("^[A-Z2-7]+$", UPPER + "234567"), ("^[a-z2-7]+$", LOWER + "234567"),
    ("^[A-Z0-9]+$", DIGITS + UPPER), ("^[a-z0-9]+$", DIGITS + LOWER),
    ("^[A-Za-z0-9]+$", DIGITS + UPPER + LOWER),
    ("^[A-Za-z0-9+/]+$", DIGITS + UPPER + LOWER + "+/"),
    ("^[A-Za-z0-9_-]+$", DIGITS + UPPER + LOWER + "-_"),
]


def _literal(pattern: str) -> str:
    return "r'" + pattern.replace("'", "\\x27") + "'"


def _starts(frame: DataFrame, steps: str, leads: str, name: str) -> DataFrame:
    """Adds the array of ``leads[i]`` plus the sum of ``steps[:i]``, by sums of blocks of 256."""
    block = f"transform(sequence(0, size({steps}) DIV 256), b -> aggregate(slice({steps}, b * 256 + 1, 256), 0, (a, x) -> a + x))"
    frame = frame.withColumn("x_blocks", F.expr(block))
    sums = "aggregate(x_blocks, array(0), (a, x) -> concat(a, array(element_at(a, -1) + x)))"
    frame = frame.withColumn("x_sums", F.expr(sums))
    start = f"x_sums[i DIV 256] + aggregate(slice({steps}, (i DIV 256) * 256 + 1, i % 256), 0, (a, x) -> a + x) + l"
    return frame.withColumn(name, F.expr(f"transform({leads}, (l, i) -> {start})")).drop("x_blocks", "x_sums")


def _found(frame: DataFrame, text: str, pattern: str, name: str, group: int = 0) -> DataFrame:
    """Adds ``name``: array of (start, end, part) of all matches; ``part`` is the given group."""
    p = _literal(pattern)
    none = "CAST(array() AS array<string>)"
    frame = frame.withColumn("x_hit", F.expr(f"coalesce({text} rlike {p}, false)"))
    frame = frame.withColumn("x_whole", F.expr(f"IF(x_hit, regexp_extract_all({text}, {p}, 0), {none})"))
    frame = frame.withColumn(
        "x_part", F.expr(f"IF(x_hit, regexp_extract_all({text}, {p}, {group}), {none})") if group else F.col("x_whole")
    )
    # What lies between the matches gives their places.
    frame = frame.withColumn("x_between", F.expr(f"IF(x_hit, split({text}, {p}, -1), {none})"))
    frame = frame.withColumn("x_leads", F.expr("transform(slice(x_between, 1, size(x_whole)), t -> char_length(t))"))
    frame = frame.withColumn("x_steps", F.expr("zip_with(x_leads, x_whole, (l, w) -> l + char_length(w))"))
    frame = _starts(frame, "x_steps", "x_leads", "x_starts")
    made = (
        "transform(x_starts, (s, i) -> named_struct('start', s, 'end', s + char_length(x_whole[i]), 'part', x_part[i]))"
    )
    frame = frame.withColumn(name, F.expr(made))
    return frame.drop("x_hit", "x_whole", "x_part", "x_between", "x_leads", "x_steps", "x_starts")


def _tail(z: str) -> str:
    """P(N(0, 1) > z), a rational approximation good to 1e-7."""
    # Coefficients of the approximation 26.2.17 of Abramowitz and Stegun.
    t = f"(1 / (1 + 0.2316419D * abs({z})))"
    poly = f"{t} * (0.319381530D + {t} * (-0.356563782D + {t} * (1.781477937D + {t} * (-1.821255978D + {t} * 1.330274429D))))"
    upper = f"(exp(-least(abs({z}), 35D) * least(abs({z}), 35D) / 2) * 0.3989422804D * {poly})"
    return f"IF({z} >= 0, {upper}, 1 - {upper})"


def _alphabet(token: str) -> str:
    cases = " ".join(
        f"WHEN {token} rlike '{p}' THEN {'NULL' if a is None else repr(a)}" for p, a in ENCODINGS
    )
    return f"CASE {cases} END"


def _tested(frame: DataFrame) -> DataFrame:
    """Turns ``candidates`` into an array of (start, end, part, n, p_uniform, p_even, k, classes).

    ``classes`` is the logarithm of how much likelier the counts of digits, letters of each case and
    marks are among uniform symbols of the alphabet than in any shares (all equally likely).
    """
    step = lambda frame, body: frame.withColumn("candidates", F.expr(f"transform(candidates, c -> {body})"))
    keep = "'start', c.start, 'end', c.end, 'part', c.part"
    frame = step(frame, f"named_struct({keep}, 'alphabet', {_alphabet('c.part')})")
    frame = frame.withColumn("candidates", F.expr("filter(candidates, c -> c.alphabet IS NOT NULL)"))
    logs = lambda n: f"aggregate(sequence(1, greatest(1, {n})), 0D, (a, i) -> a + ln(i))"
    size = lambda text, symbols: f"char_length(regexp_replace({text}, '[^{symbols}]', ''))"
    classes = [(size("c.alphabet", s), size("c.part", s)) for s in ("0-9", "a-z", "A-Z", "+/_-")]
    others = f"({' + '.join(f'IF({all_of} > 0, 1, 0)' for all_of, _ in classes)} - 1)"
    shares = " + ".join(
        f"{own} * ln(greatest({all_of}, 1) / char_length(c.alphabet)) - {logs(own)}" for all_of, own in classes
    )
    frame = step(
        frame,
        f"named_struct({keep}, 'alphabet', c.alphabet, "
        f"'classes', {logs(f'char_length(c.part) + {others}')} - {logs(others)} + {shares})",
    )
    keep = (
        "'start', c.start, 'end', c.end, 'part', c.part, 'n', char_length(c.part), "
        "'k', CAST(char_length(c.alphabet) AS double), 'classes', c.classes"
    )
    squares = (
        "aggregate(sequence(1, char_length(c.alphabet)), 0D, (a, s) -> a + "
        "pow(char_length(c.part) - char_length(replace(c.part, substr(c.alphabet, s, 1), '')), 2))"
    )
    half = "translate(c.part, c.alphabet, rpad(repeat('0', char_length(c.alphabet) DIV 2), char_length(c.alphabet), '1'))"
    places = "transform(split(c.part, ''), x -> CAST(instr(c.alphabet, x) AS double))"
    frame = step(
        frame,
        f"named_struct({keep}, 'squares', {squares}, 'halves', {half}, 'places', {places})",
    )
    keep = "'start', c.start, 'end', c.end, 'part', c.part, 'n', c.n, 'k', c.k, 'classes', c.classes"
    sum_of = lambda array: f"aggregate({array}, 0D, (a, x) -> a + x)"
    mean = f"({sum_of('c.places')} / c.n)"
    frame = step(
        frame,
        f"named_struct({keep}, 'chi', c.k / c.n * c.squares - c.n, "
        "'repeats', (c.squares - c.n) / (CAST(c.n AS double) * (c.n - 1)), "
        "'runs', 1 + (c.n - char_length(replace(c.halves, '01', ''))) / 2 + (c.n - char_length(replace(c.halves, '10', ''))) / 2, "
        "'ones', CAST(char_length(replace(c.halves, '0', '')) AS double), "
        f"'off', transform(c.places, x -> x - {mean}))",
    )
    frame = step(
        frame,
        f"named_struct({keep}, 'chi', c.chi, 'repeats', c.repeats, 'runs', c.runs, "
        "'expected', 2 * c.ones * (c.n - c.ones) / c.n + 1, "
        "'lagged', aggregate(zip_with(slice(c.off, 1, c.n - 1), slice(c.off, 2, c.n - 1), (x, y) -> x * y), 0D, (a, x) -> a + x), "
        "'spread', aggregate(c.off, 0D, (a, x) -> a + x * x))",
    )
    cubic = "((pow(greatest(c.chi, 0D) / (c.k - 1), 1 / 3D) - (1 - 2 / (9 * (c.k - 1)))) / sqrt(2 / (9 * (c.k - 1))))"
    runs = (
        "IF(c.expected <= 2, 40D, abs(c.runs - c.expected) / sqrt((c.expected - 1) * (c.expected - 2) / (c.n - 1)))"
    )
    serial = "IF(c.spread <= 0, 40D, abs(c.lagged / c.spread + 1D / c.n) * sqrt(c.n))"
    rate = f"({TEXT_LIKE}D / c.k)"
    even = f"(({rate} - c.repeats) / sqrt(2 * {rate} * (1 - {rate}) / (CAST(c.n AS double) * (c.n - 1))))"
    frame = step(
        frame, f"named_struct({keep}, 'z_chi', {cubic}, 'z_runs', {runs}, 'z_serial', {serial}, 'z_even', {even})"
    )
    return step(
        frame,
        f"named_struct({keep}, 'p_uniform', least(1D, 3 * least({_tail('c.z_chi')}, 2 * {_tail('c.z_runs')}, "
        f"2 * {_tail('c.z_serial')})), 'p_even', {_tail('c.z_even')})",
    )


APART = " AND ".join(
    f"NOT exists({kind}, s -> s.start < c.end AND c.start < s.end)" for kind in ("assign", "access", "hex")
)


def _unlike(words: DataFrame) -> tuple[dict[str, float], dict[str, float]]:
    """By letter, the logarithm of how much rarer it is in words than if all were equally likely.

    For all letters and for those of hexadecimal numbers alone. Every distinct one of the array
    ``words`` counts once, so that a word of a thousand copies does not stand for all text. 26 counts
    reach the driver.
    """
    distinct = words.select(F.explode("words").alias("word")).distinct()
    letters = distinct.select(F.explode(F.split("word", "")).alias("letter")).groupBy("letter").count()
    counts = {row["letter"]: row["count"] for row in letters.filter("letter rlike '^[a-z]$'").collect()}

    def among(alphabet: str) -> dict[str, float]:
        all_of = sum(counts.get(x, 0) + 0.5 for x in alphabet)
        return {x: math.log(all_of / (len(alphabet) * (counts.get(x, 0) + 0.5))) for x in alphabet}

    return among(LOWER), among("abcdef")


def _judged(frame: DataFrame, words: DataFrame) -> DataFrame:
    """Adds p_text to ``candidates``: the smaller of two p-values, doubled.

    One is that of evenness. The other holds the letters against those of ``words``: uniform symbols
    over text-like ones is a ratio of likelihoods, which text reaches with a chance of one over it.
    """
    every, hexadecimal = (
        "map(" + ", ".join(f"'{x}', {log!r}D" for x, log in found.items()) + ")" for found in _unlike(words)
    )
    log = f"IF(c.k = 16, element_at({hexadecimal}, x), element_at({every}, x))"
    ratio = f"aggregate(split(lower(c.part), ''), c.classes, (a, x) -> a + coalesce({log}, 0D))"
    p_text = f"least(1D, 2 * least(c.p_even, exp(-greatest(0D, {ratio}))))"
    keep = "'start', c.start, 'end', c.end, 'part', c.part, 'n', c.n, 'p_uniform', c.p_uniform"
    return frame.withColumn("candidates", F.expr(f"transform(candidates, c -> named_struct({keep}, 'p_text', {p_text}))"))


WEIGHT = "least(c.n, 64)"  # longer candidates are likelier secrets


def _threshold(candidates: DataFrame) -> tuple[float, float]:
    """Largest weighted p-value that keeps the false-discovery rate, and the mean weight.

    ``candidates`` has a column ``c``. What reaches the driver is a histogram of BINS counts.
    """
    mean = candidates.agg(F.avg(F.expr(WEIGHT)).alias("m")).first()["m"]
    if mean is None:
        return -1.0, 1.0
    scaled = F.expr(f"c.p_text / ({WEIGHT} / {mean!r}D)")
    place = F.least(F.lit(BINS), F.floor(-F.log10(F.greatest(scaled, F.lit(1e-30))) * 20)).cast("int")
    # A bin holds p-values up to 10^(-bin / 20); those the battery rejects count as not discovered.
    rows = candidates.groupBy(place.alias("bin")).agg(
        F.count("*").alias("all"), F.sum(F.expr(f"IF(c.p_uniform >= {REJECT}D, 1, 0)")).alias("passed")
    ).collect()
    total, passed, limit = sum(r["all"] for r in rows), 0, -1.0
    for row in sorted(rows, key=lambda r: -r["bin"]):
        passed += row["passed"]
        edge = math.pow(10, -row["bin"] / 20)
        if edge * total <= RATE * passed:
            limit = edge
    return limit, mean


def _scanned(docs: DataFrame) -> DataFrame:
    frame = _found(docs, "text", ASSIGN, "assign", group=2)
    frame = frame.withColumn("assign", F.expr(f"filter(assign, s -> char_length(s.part) >= {LEAST['assign']})"))
    frame = _found(frame, "text", LONG_ACCESS, "access")
    frame = _found(frame, "text", LONG_HEX, "hex")
    frame = _found(frame, "text", CANDIDATE, "candidates")
    words = f"transform(filter(candidates, c -> c.part rlike '{WORDS}' AND {APART}), c -> lower(c.part))"
    return _tested(frame.withColumn("words", F.expr(f"array_distinct({words})")))


def _decided(frame: DataFrame) -> DataFrame:
    """Adds ``random``: the candidates found random that do not overlap a base span."""
    frame = _judged(frame, frame)
    limit, mean = _threshold(frame.select(F.explode("candidates").alias("c")))
    keep = f"c.p_uniform >= {REJECT}D AND c.p_text / ({WEIGHT} / {mean!r}D) <= {limit!r}D AND {APART}"
    return frame.withColumn("random", F.expr(f"filter(candidates, c -> {keep})"))


def _as_text(kinds: list[str]) -> Column:
    tagged = ", ".join(
        f"transform({kind}, s -> named_struct('start', s.start, 'kind', {KINDS.index(kind)}, 'end', s.end, "
        f"'text', concat('{kind}:', s.start, ':', s.end)))"
        for kind in kinds
    )
    return F.expr(f"array_join(transform(array_sort(concat({tagged})), s -> s.text), ',')")


def find_secrets(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, n_random, base_sha256, spans of each row of ``docs``.

    Spans are ``kind:start:end`` in code points, end exclusive, by start and then kind. A null or
    empty text has none, and the hash of the empty string. Null ids stay null, repeated rows stay,
    other columns are left out; an empty table gives no rows. Added spans depend on all candidates
    of the input through the false-discovery rate; base spans depend on their text alone.
    """
    scanned = _scanned(docs.select("doc_id", "text"))
    kept = stored(scanned.drop("text"), "secrets")
    found = _decided(kept)
    counts = [F.size(kind).cast("long").alias(f"n_{kind}") for kind in KINDS]
    return found.select(
        "doc_id", *counts, F.sha2(_as_text(KINDS[:3]), 256).alias("base_sha256"), _as_text(KINDS).alias("spans")
    )


MARK = "[secret]"


def redact(docs: DataFrame) -> DataFrame:
    """The documents with every found secret replaced by a mark; columns as given.

    ``n_chars`` follows the new text. A document without secrets is unchanged, null texts too.
    """
    names = docs.columns
    row = F.struct(*(F.col(f"`{name}`") for name in names)).alias("x_row")
    scanned = _scanned(docs.select(row, F.col("text").alias("text")))
    kept = stored(scanned.drop("text"), "secrets")
    found = _decided(kept)
    cleaned = F.expr(
        f"aggregate(array_distinct(transform(random, s -> s.part)), x_row.text, (t, s) -> replace(t, s, '{MARK}'))"
    )
    some = F.expr("size(assign) + size(access) + size(hex) + size(random) > 0")
    found = found.withColumn("x_text", F.when(some, cleaned).otherwise(F.col("x_row.text")))
    # A match of the pattern with fewer characters than the least may hide a longer one after it:
    # replacing all long enough values covers every span.
    long_assign = ASSIGN.replace("([A-Za-z0-9+/_.=-]+)", "([A-Za-z0-9+/_.=-]{6,})")
    replaced = F.col("x_text")
    for pattern in (long_assign, LONG_ACCESS, LONG_HEX):
        replaced = F.regexp_replace(replaced, F.lit(pattern), F.lit(MARK))
    found = found.withColumn("x_text", F.when(some, replaced).otherwise(F.col("x_text")))
    columns = []
    for name in names:
        if name == "text":
            columns.append(F.col("x_text").alias("text"))
        elif name == "n_chars":
            size = F.char_length("x_text").cast(docs.schema[name].dataType)
            columns.append(F.when(some, size).otherwise(F.col("x_row.n_chars")).alias(name))
        else:
            columns.append(F.col(f"x_row.`{name}`").alias(name))
    return found.select(*columns)
