"""URL filter: host rules first, then a weighted vocabulary found by Aho-Corasick.

A rule (host, path) fits its host and all subdomains if the url's path starts with
the rule's path; the longest fitting rule (host and path together, then the longer
host) decides. Other urls are searched whole for the vocabulary's terms. A hit
counts only between boundaries: the characters beside it are no ASCII letters or
digits. The weights of the distinct terms found are added; a strict term weighs 1,
a soft one less, and from a sum of ``LIMIT`` on the url is blocked: one strict term
or several different soft ones.

Defined results: a null url, or one without ``://``, has an empty host and path, fits
no rule and is judged by its vocabulary alone (null: allow). Repeated terms count
once in the sum and each time in ``n_hits``. Rows are independent of each other, so a
host with a third of all rows is only more rows of a map.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import docs_of, map_rows, table

# The given host rules, as (verdict, host, path).
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)

#: Parameters: terms that block alone, and terms that need company with their weights.
STRICT = ("casino", "casinos", "gambling", "malware", "phishing", "porn", "spam", "viagra", "xxx")
SOFT = {
    "ad": 0.5, "ads": 0.5, "adult": 0.5, "bet": 0.5, "bets": 0.5, "bonus": 0.5, "cheap": 0.5, "click": 0.5,
    "deals": 0.5, "discount": 0.5, "farm": 0.5, "free": 0.5, "jackpot": 0.5, "loan": 0.5, "loans": 0.5,
    "lottery": 0.5, "payday": 0.5, "pill": 0.5, "pills": 0.5, "poker": 0.5, "promo": 0.5, "replica": 0.5,
    "slots": 0.5, "track": 0.5, "tracker": 0.5, "tracking": 0.5, "win": 0.5, "winner": 0.5,
}
LIMIT = 1.0

SCHEMA = ("page_id long, host string, path string, rule string, verdict string, "
          "n_strict long, n_soft long, n_hits long, weight double")
UPPER = {c: c + 32 for c in range(65, 91)}


def host_path(url: str | None) -> tuple[str, str]:
    """Host with A-Z lower-cased, and path, as the module's text defines them."""
    _, found, rest = (url or "").partition("://")
    if not found:
        return "", ""
    end = next((i for i, c in enumerate(rest) if c in "/?#"), len(rest))
    tail = rest[end:]
    stop = next((i for i, c in enumerate(tail) if c in "?#"), len(tail))
    return rest[:end].translate(UPPER), tail[:stop]


def rule_of(host: str, path: str, rules=RULES) -> tuple[str, str] | None:
    """(rule text, verdict) of the longest rule that fits."""
    fits = [(len(h) + len(p), len(h), h + p, v) for v, h, p in rules
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[2:] if fits else None


def automaton(strict=STRICT, soft=SOFT):
    import ahocorasick

    a = ahocorasick.Automaton()
    for t, w in [*((t, 1.0) for t in strict), *soft.items()]:
        a.add_word(t, (t, w))
    a.make_automaton()
    return a


def hits(a, url: str) -> list[tuple[str, float]]:
    """Terms between boundaries in the lower-cased url, each as often as it stands."""
    text, out = url.translate(UPPER), []
    for end, (term, weight) in a.iter(text):
        before, after = text[end - len(term):end - len(term) + 1] if end >= len(term) else "", text[end + 1:end + 2]
        if not (before and before.isascii() and before.isalnum()) and not (after and after.isascii() and after.isalnum()):
            out.append((term, weight))
    return out


def judge_urls(pages: DataFrame, rules=RULES, strict=STRICT, soft=None, limit: float = LIMIT) -> DataFrame:
    """One row per row of ``pages`` (page_id, url)."""
    soft = dict(SOFT if soft is None else soft)

    def make():
        a = automaton(strict, soft)

        def judge(cols):
            out = [[] for _ in range(9)]
            for key, url in zip(*cols, strict=True):
                host, path = host_path(url)
                rule = rule_of(host, path, rules)
                found = hits(a, url or "")
                distinct = dict(found)
                weight = sum(distinct.values())
                verdict = rule[1] if rule else "block" if weight >= limit else "allow"
                n_strict = sum(t in strict for t in distinct)
                row = (key, host, path, rule and rule[0], verdict, n_strict, len(distinct) - n_strict, len(found), weight)
                for c, v in zip(out, row, strict=True):
                    c.append(v)
            return out

        return judge

    rows = docs_of(pages, "page_id", "url").select(F.col("page_id").cast("long"), F.col("url").cast("string"))
    return map_rows(rows, SCHEMA, make)


def op10_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every url of ``pages``."""
    return judge_urls(table(spark, sf_dir, "pages")).drop("n_hits")


def _sql() -> str:
    edge = "[^0-9a-z]"
    seen = [(t, 1.0, f"regexp_matches(low, '(^|{edge}){t}({edge}|$)')") for t in STRICT]
    soft = [(t, w, f"regexp_matches(low, '(^|{edge}){t}({edge}|$)')") for t, w in SOFT.items()]
    fits = [(v, h, p, f"(host = '{h}' OR host LIKE '%.{h}') AND starts_with(path, '{p}')")
            for v, h, p in sorted(RULES, key=lambda r: (-len(r[1] + r[2]), -len(r[1])))]
    add = lambda xs, f: " + ".join(f(x) for x in xs)
    return f"""
WITH parts AS (
  SELECT page_id, coalesce(url, '') AS url,
         regexp_extract(coalesce(url, ''), '(?s)^(.*?)://([^/?#]*)([^?#]*)', 2) AS h,
         regexp_extract(coalesce(url, ''), '(?s)^(.*?)://([^/?#]*)([^?#]*)', 3) AS path FROM pages),
lowered AS (
  SELECT page_id, translate(h, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, path,
         translate(url, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low FROM parts),
judged AS (
  SELECT page_id, host, path,
         CASE {" ".join(f"WHEN {c} THEN '{h}{p}'" for _, h, p, c in fits)} END AS rule,
         CASE {" ".join(f"WHEN {c} THEN '{v}'" for v, _, _, c in fits)} END AS ruled,
         {add(seen, lambda x: f"{x[2]}::BIGINT")} AS n_strict,
         {add(soft, lambda x: f"{x[2]}::BIGINT")} AS n_soft,
         {add(seen + soft, lambda x: f"{x[1]}::DOUBLE * {x[2]}::INT")} AS weight FROM lowered)
SELECT page_id, host, path, rule,
       coalesce(ruled, CASE WHEN weight >= {LIMIT} THEN 'block' ELSE 'allow' END) AS verdict, n_strict, n_soft, weight
FROM judged
"""


ORACLE = _sql()
