"""URL filter: pattern rules found through their rarest literal token.

Every rule names the whole tokens that any matching URL must contain. Token
frequencies are counted over the URLs themselves; each rule is filed under its
rarest token. A URL fetches the rules under its own tokens, and only those run
their regular expressions.

Rules come as places (host and path prefix) or as lines of a filter list: ``||`` opens a
host or subdomain, ``|`` ends an address, ``*`` stands for anything, ``^`` for a separator or
the end, ``@@`` for an exception, ``!`` for a comment.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from vocatio.llm.tables import stored

_TOKEN = r"[a-z0-9]+"


@dataclass(frozen=True)
class Rule:
    verdict: str  # allow or block
    pattern: str  # Java regular expression over host + "#" + path, query and fragment; no host holds a "#"
    tokens: tuple[str, ...]  # whole tokens of every URL that matches; none: always tried
    length: int  # the longest match wins
    name: str | None = None  # reported as the rule; a pattern of the method has none
    exception: bool = False  # an allowing pattern that beats blocking ones


def _quoted(text: str) -> str:
    return "".join(c if c.isalnum() or c == "_" or c > "\x7f" else "\\" + c for c in text)


def place(verdict: str, host: str, path: str) -> Rule:
    """A rule for a host and its subdomains and a path prefix."""
    tokens = re.findall(_TOKEN, host)
    # The last token of a prefix may go on in the URL, unless something else ends it.
    in_path = re.findall(rf"{_TOKEN}(?=[^a-z0-9])", path.lower())
    return Rule(
        verdict, rf"(?s)^([^#]*\.)?{_quoted(host)}#{_quoted(path)}", tuple([*tokens, *in_path]),
        len(host) + len(path), host + path,
    )


def words_in_host(verdict: str, *words: str) -> Rule:
    """A rule for hosts with these words joined by hyphens as a whole label part."""
    joined = "-".join(words)
    return Rule(verdict, rf"(?s)^([^#]*[.-])?{joined}([.-][^#]*)?#", tuple(words), 0)


def listed(line: str) -> Rule | None:
    """The rule of a line of a filter list; None for a comment, an empty rule or one with options.

    Letters match in either case. A rule without ``||`` fits anywhere in host, path and query.
    """
    line = line.strip()
    if not line or line.startswith("!") or "$" in line:
        return None
    exception = line.startswith("@@")
    body = line[2:] if exception else line
    at_host = body.startswith("||")
    body = body[2:] if at_host else body
    at_end = body.endswith("|")
    body = re.sub(r"\*+", "*", body[:-1] if at_end else body)
    if not body:
        return None
    # A "#" may stand between host and path, so it may go before whatever can open a path.
    parts = {"*": ".*", "^": r"(?:#?[^A-Za-z0-9_.%#-]|#|$)", "/": "#?/", "?": r"#?\?"}
    pattern = "".join(parts.get(c) or _quoted(c) for c in body)
    pattern = (r"^(?:[^#]*\.)?" if at_host else "") + pattern + ("#?$" if at_end else "")
    # A run of letters and digits is a whole token of every match if it is bounded on both sides.
    tokens = []
    for found in re.finditer(_TOKEN, body.lower()):
        opened = body[found.start() - 1] != "*" if found.start() else at_host
        closed = body[found.end()] != "*" if found.end() < len(body) else at_end
        if opened and closed:
            tokens.append(found.group())
    return Rule("allow" if exception else "block", f"(?is){pattern}", tuple(tokens), 0, None, exception)


def listed_rules(lines) -> list[Rule]:
    """The rules of the lines of a filter list, such as ``row.value for row in spark.read.text(path).collect()``."""
    return [rule for line in lines if (rule := listed(line)) is not None]


def judge(
    urls: DataFrame, rules: list[Rule], otherwise: str = "allow", index_rows: int = 100_000
) -> DataFrame:
    """Each row's host, path, rule, pattern and verdict. Column ``url`` is judged; page_id is kept.

    The longest named rule decides; without one, an exception, then a block pattern, then another
    allow pattern, then ``otherwise``. A null URL and one without ``://`` have an empty host and path and get
    ``otherwise`` unless a rule without tokens fits. Equal URLs are judged once; every row is
    returned, repeated ones too. The index is broadcast below ``index_rows`` rules, joined by
    shuffle beyond. Other columns are left out; an empty table gives no rows.
    """
    spark = urls.sparkSession
    rest = F.when(F.instr("url", "://") > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise("")
    lowered = F.translate(
        F.regexp_extract(F.col("rest"), r"^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    )
    parts = (
        urls.select("url").distinct().withColumn("rest", rest)
        .withColumn("host", lowered)
        .withColumn("path", F.regexp_extract("rest", r"^[^/?#]*([^?#]*)", 1))
        .withColumn("target", F.concat("host", F.lit("#"), F.regexp_extract("rest", r"(?s)^[^/?#]*(.*)", 1)))
    )
    parts = stored(parts.select("url", "host", "path", "target"), "url-parts")
    tokens = F.explode(F.array_distinct(F.regexp_extract_all(F.lower("target"), F.lit(_TOKEN), F.lit(0))))
    of_urls = parts.select("url", "target", tokens.alias("token"))

    numbered = list(enumerate(rules))
    named = spark.createDataFrame(
        [(i, t) for i, rule in numbered for t in dict.fromkeys(rule.tokens)], "rule_no int, token string"
    )
    known = spark.createDataFrame(
        [(i, r.verdict, r.pattern, r.length, r.name, r.exception, not r.tokens) for i, r in numbered],
        "rule_no int, verdict string, pattern string, length int, name string, exception boolean, bare boolean",
    )
    small = F.broadcast if len(rules) <= index_rows else (lambda frame: frame)
    counts = of_urls.join(small(named.select("token").distinct()), "token").groupBy("token").count()
    rarest = (
        named.join(counts, "token", "left").groupBy("rule_no")
        .agg(F.min(F.struct(F.coalesce("count", F.lit(0)).alias("n"), F.col("token"))).alias("least"))
        .select("rule_no", F.col("least.token").alias("token"))
    )
    index = rarest.join(known, "rule_no")
    fetched = of_urls.join(small(index), "token").drop("token")
    if any(not rule.tokens for rule in rules):
        bare = known.filter("bare")
        always = parts.select("url", "target", F.lit(True).alias("bare")).join(small(bare), "bare")
        fetched = fetched.unionByName(always, allowMissingColumns=True)
    # Named rules first, then exceptions, then block before allow; the rule number settles ties.
    order = F.struct(
        F.col("name").isNotNull().alias("named"),
        F.when(F.col("name").isNotNull(), F.col("length")).otherwise(0).alias("length"),
        "exception",
        (F.col("verdict") == "block").alias("block"),
        (-F.col("rule_no")).alias("first"),
        "name", "verdict", "pattern",
    )
    best = (
        fetched.filter(F.expr("target rlike pattern")).groupBy("url").agg(F.max(order).alias("best"))
    )
    decided = parts.join(best, "url", "left").select(
        "url", "host", "path",
        F.col("best.name").alias("rule"),
        F.when(F.col("best.name").isNull(), F.col("best.pattern")).alias("pattern"),
        F.coalesce("best.verdict", F.lit(otherwise)).alias("verdict"),
    )
    page, seen = urls.select("page_id", "url").alias("p"), decided.alias("d")
    return page.join(seen, F.col("p.url").eqNullSafe(F.col("d.url")), "left").select(
        "p.page_id", "d.host", "d.path", "d.rule", "d.pattern", "d.verdict"
    )
