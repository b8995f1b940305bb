"""URL filter: host and path rules, and block decisions that follow redirect and canonical links."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartloom.llm.common import attach, durable, lower_ascii, query, table
from cartloom.llm.graph import components

RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]

PARTS = r"(?s)\A.*?://([^/?#]*)([^?#]*)"
#: What a browser does not read as tags: comments and the text of raw-text elements.
UNREAD = (
    r"(?is)<!--(?:-?>|.*?--!?>|.*\z)|<script\b[^>]*>.*?(?:</script[^>]*>|\z)|<style\b[^>]*>.*?(?:</style[^>]*>|\z)"
    r"|<textarea\b[^>]*>.*?(?:</textarea[^>]*>|\z)|<title\b[^>]*>.*?(?:</title[^>]*>|\z)"
)
TAGS = r"(?is)<((?:link|meta|base)[\s/][^>]*)>"
ATTRIBUTE = r"""(?s)([^\s"'>/=]+\s*=\s*(?:"[^"]*"|'[^']*'|[^\s"'>]+))"""
#: A refresh with a target: a delay and a separator, or the word url.
TARGETED = r"(?is)\A\s*(?:[0-9][0-9.]*[\s;,]|[\s;,]*url\s*=)"
DELAY = r"(?is)\A\s*[0-9.]*[\s;,]*"
WORD = r"(?is)\Aurl\s*=\s*"
QUOTED = r"""(?s)\A(?:"([^"]*)|'([^']*)|([^"'].*))"""
REFERENCE = r"(?s)(&#[xX][0-9A-Fa-f]+;?|&#[0-9]+;?|&[A-Za-z]+;|[^&]+|&)"
#: Character references by name that have a place in urls.
NAMED = {"&amp;": "&", "&quot;": '"', "&apos;": "'", "&lt;": "<", "&gt;": ">"}
#: Scheme, user and host of a url.
SITE = r"(?s)\A([A-Za-z][A-Za-z0-9+.\-]*://)([^/?#]*@)?([^/?#]*)"


def host_of(url: Column) -> Column:
    """Text after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    host = F.coalesce(F.regexp_extract(url, PARTS, 1), F.lit(""))
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, PARTS, 2), F.lit(""))


def resource(url: Column) -> Column:
    """The url without its fragment, which no server sees, A-Z of scheme and host lower-cased."""
    bare = F.substring_index(url, "#", 1)
    part = lambda k: F.regexp_extract(bare, SITE, k)
    rest = F.substring(bare, F.length(part(0)) + 1, F.length(bare))
    return F.concat(lower_ascii(part(1)), part(2), lower_ascii(part(3)), rest)


def _bound(value: Column, fn: Callable[[Column], Column]) -> Column:
    """``fn(value)`` with the value computed once, however often ``fn`` names it."""
    return F.element_at(F.transform(F.array(value), fn), 1)


def _without_dots(path: Column) -> Column:
    """A path from the root without its ``.`` and ``..`` segments."""
    shorter = lambda kept: F.slice(kept, 1, F.greatest(F.size(kept) - 1, F.lit(0)))
    step = lambda kept, s: F.when(s == "..", shorter(kept)).when(s == ".", kept).otherwise(F.concat(kept, F.array(s)))
    segments = F.split(path, "/")
    kept = F.aggregate(F.slice(segments, 2, F.size(segments)), F.array().cast("array<string>"), step)
    ended = path.rlike(r"/\.\.?\z")
    return _bound(kept, lambda k: F.concat(F.lit("/"), F.array_join(k, "/"), F.when(ended & (F.size(k) > 0), "/").otherwise("")))


def resolve(target: Column, base: Column) -> Column:
    """``target`` as a url seen from ``base``; NULL where that names no host.

    A target with a scheme stays as written. Others take the scheme of the base
    (``//``), its scheme and host (``/``), its path as well (``?`` and ``#``), or the
    folder of its path, and lose dot segments.
    """
    bare = F.substring_index(base, "#", 1)
    site = F.regexp_extract(bare, SITE, 0)
    path = F.regexp_extract(F.substring(bare, F.length(site) + 1, F.length(bare)), r"\A[^?]*", 0)
    tail = lambda full: F.regexp_extract(full, r"(?s)\A[^?#]*(.*)", 1)
    inside = lambda full: F.concat(_bound(F.regexp_extract(full, r"\A[^?#]*", 0), _without_dots), tail(full))

    def below(known: Column) -> Column:
        site, path, to = known["site"], known["path"], known["to"]
        folder = F.when(path == "", "/").otherwise(F.regexp_extract(path, r"(?s)\A(.*/)", 1))
        return (
            F.when(to.rlike(r"\A[A-Za-z][A-Za-z0-9+.\-]*:"), F.when(F.contains(to, F.lit("://")), to))
            .when(site == "", None)
            .when(to.startswith("//"), F.concat(F.substring_index(site, "//", 1), to))
            .when(to.startswith("?"), F.concat(site, path, to))
            .when(to.startswith("#"), F.concat(site, path, known["query"]))
            .otherwise(F.concat(site, _bound(F.when(to.startswith("/"), to).otherwise(F.concat(folder, to)), inside)))
        )

    query = F.regexp_extract(bare, r"(?s)\A[^?]*(.*)", 1)
    return _bound(F.named_struct(F.lit("site"), site, F.lit("path"), path, F.lit("query"), query, F.lit("to"), target), below)


def _attribute(tag: Column, name: str) -> Column:
    """The value of the first attribute ``name`` of a tag, quotes taken off; empty without one."""
    own = F.filter(
        F.regexp_extract_all(tag, F.lit(ATTRIBUTE), 1), lambda a: F.lower(F.regexp_extract(a, r"\A[^\s=]+", 0)) == name
    )
    value = F.regexp_replace(F.get(own, F.lit(0)), r"(?s)\A[^\s=]+\s*=\s*", "")
    bare = F.when(value.rlike(r"""(?s)\A["']"""), F.substring(value, F.lit(2), F.length(value) - 2)).otherwise(value)
    return F.coalesce(bare, F.lit(""))


def _referred(part: Column) -> Column:
    """One character reference, decoded; other text as it is."""
    digits = F.regexp_extract(part, r"\A&#0*([0-9]{1,7});?\z", 1)
    hexed = F.regexp_extract(part, r"\A&#[xX]0*([0-9A-Fa-f]{1,6});?\z", 1)
    code = F.coalesce(
        F.when(digits != "", digits.try_cast("long")), F.when(hexed != "", F.conv(hexed, 16, 10).try_cast("long"))
    )
    known = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
    wide = F.decode(F.unhex(F.lpad(F.hex(F.when(known, code)), 8, "0")), "UTF-32")
    named = F.element_at(F.create_map(*[F.lit(v) for pair in NAMED.items() for v in pair]), F.lower(part))
    return F.coalesce(F.when(part.startswith("&#"), wide).otherwise(named), part)


def unescaped(text: Column) -> Column:
    """``text`` with numeric character references and those of ``NAMED`` decoded, each once.

    A number that is no character stays as written, as does any other name.
    """
    parts = F.transform(F.regexp_extract_all(text, F.lit(REFERENCE), 1), _referred)
    return F.when(F.contains(text, F.lit("&")), F.array_join(parts, "")).otherwise(text)


def _target(tag: Column) -> Column:
    """Where a canonical link or a refresh leads, as written; empty for other tags."""
    tokens = F.split(F.lower(unescaped(_attribute(tag, "rel"))), r"\s+")
    canonical = tag.rlike(r"(?i)\Alink\b") & F.array_contains(tokens, "canonical")
    refresh = tag.rlike(r"(?i)\Ameta\b") & (F.lower(F.trim(_attribute(tag, "http-equiv"))) == "refresh")
    content = unescaped(_attribute(tag, "content"))
    said = F.regexp_replace(F.regexp_replace(content, DELAY, ""), WORD, "")
    led = F.when(content.rlike(TARGETED), F.concat(*[F.regexp_extract(said, QUOTED, k) for k in (1, 2, 3)]))
    out = F.when(canonical, unescaped(_attribute(tag, "href"))).when(refresh, led)
    return F.regexp_replace(F.coalesce(out, F.lit("")), r"\A\s+|\s+\z", "")


def link_edges(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """Columns ``a, b``: a page's resource and the target of its canonical or refresh link.

    Tags inside comments, scripts, styles, titles and text areas are not read. ``rel`` is a
    list of words; the target of a refresh may stand in quotes of its own; character
    references are decoded. References are resolved against the page's first base element
    with a target, else its url; those that name no host are not edges. A NULL page or url
    gives none.
    """
    linked = F.col(html).rlike(r"(?i)canonical|http-equiv") & F.col(url).isNotNull()
    read = F.regexp_replace(F.col(html), UNREAD, " ")
    pages = pages.where(linked).select(F.col(url).alias("_from"), F.regexp_extract_all(read, F.lit(TAGS), 1).alias("_tags"))
    bases = F.filter("_tags", lambda t: t.rlike(r"(?i)\Abase\b"))
    bases = F.filter(F.transform(bases, lambda t: unescaped(_attribute(t, "href"))), lambda b: b != "")
    own = F.coalesce(F.get(bases, F.lit(0)), F.lit(""))
    base = _bound(own, lambda b: F.coalesce(F.when(b != "", resolve(b, F.col("_from"))), F.col("_from")))
    targets = F.filter(F.transform("_tags", _target), lambda t: t != "")
    found = pages.select("_from", base.alias("_base"), F.explode(targets).alias("_to"))
    to = _bound(resolve(F.col("_to"), F.col("_base")), resource)
    return found.select(resource(F.col("_from")).alias("a"), to.alias("b")).where("b IS NOT NULL")


def _decide(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """Add ``rule`` and ``decision`` of the longest fitting rule to stored rows with ``host, path``.

    Host suffixes meet rule hosts once per distinct host, and the fitting rules return
    to the rows by ``attach``: a host or a suffix may hold a third of all rows. Of two
    rules of equal length ``allow`` wins.
    """
    hosts = durable(urls.groupBy("host").agg(F.count("*").alias("n")))
    labels = F.split("host", r"\.")
    tails = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    suffixes = durable(hosts.select("host", F.explode(F.array_distinct(tails)).alias("suffix")))
    ruled = rules.groupBy(F.col("host").alias("suffix")).agg(F.collect_set(F.struct("path", "action")).alias("paths"))
    counts = suffixes.groupBy("suffix").agg(F.count("*").alias("n"))
    known = durable(ruled.join(counts, "suffix"))
    fitting = attach(suffixes, known, ["suffix"], "n", how="inner")
    entries = F.transform("paths", lambda p: F.struct(F.concat("suffix", p["path"]).alias("rule"), p["path"].alias("path"), p["action"].alias("action")))
    by_host = fitting.groupBy("host").agg(F.flatten(F.collect_list(entries)).alias("entries"))
    facts = durable(hosts.join(by_host, "host"))
    rows = attach(urls, facts, ["host"], "n")
    fits = F.filter("entries", lambda e: F.startswith("path", e["path"]))
    order = F.transform(fits, lambda e: F.struct(F.length(e["rule"]).alias("size"), (e["action"] == "allow").alias("allows"), e["rule"].alias("rule"), e["action"].alias("action")))
    best = F.array_max(order)
    return rows.withColumns({"rule": best["rule"], "decision": best["action"]}).drop("entries")


def judge(pages: DataFrame, rules: DataFrame, edges: DataFrame, page_id: str = "page_id", url: str = "url") -> DataFrame:
    """Verdict for every row of ``pages`` as ``page_id, host, path, rule, verdict``.

    ``rules`` has ``host, path, action`` (allow or block): a rule fits its host and all
    subdomains where the path starts with its path, and the longest wins. ``edges``
    (``a, b``: urls as ``resource`` gives them) joins urls into aliases. A url without a rule is
    blocked where any alias is blocked by a rule, even one that was never fetched, and
    else allowed; its own allow rule precedes a block that an alias would hand down.
    A NULL url has an empty host and path, no aliases, and is allowed without a rule;
    repeated rows are each judged; no rows give no rows.
    """
    links = durable(edges)
    asked = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), resource(F.col(url)).alias("node"), F.lit(True).alias("page"))
    ends = links.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    named = ends.select(F.lit(None).cast(pages.schema[page_id].dataType).alias("page_id"), F.col("node").alias("url"), "node", F.lit(False).alias("page"))
    rows = asked.unionByName(named)
    rows = durable(rows.select("page_id", "node", "page", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")))
    decided = durable(_decide(rows, rules))
    member = durable(components(links.select("a", "b")))
    blocked = decided.where("decision = 'block' AND NOT page").select("node").distinct()
    bad = member.join(blocked, "node").select("component").distinct()
    per_node = member.join(bad, "component", "left_semi").select("node")
    pages_of = decided.where("page").groupBy("node").agg(F.count("*").alias("n"))
    spread = durable(per_node.join(pages_of, "node").select("node", F.lit(True).alias("tainted"), "n"))
    out = attach(decided.where("page"), spread, ["node"], "n")
    verdict = F.coalesce("decision", F.when(F.col("tainted"), "block"), F.lit("allow"))
    return out.select("page_id", "host", "path", "rule", verdict.alias("verdict"))


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]] = RULES) -> DataFrame:
    entries = [F.struct(*[F.lit(v).alias(n) for n, v in zip(("host", "path", "action"), rule)]) for rule in rules]
    return spark.range(1).select(F.inline(F.array(*entries)))


_RULES = ", ".join(f"('{h}', '{p}', '{a}')" for h, p, a in RULES)

def _lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _attribute_sql(tag: str, name: str) -> str:
    own = f"list_filter(regexp_extract_all({tag}, {_lit(ATTRIBUTE)}, 1), lambda a: lower(regexp_extract(a, '\\A[^\\s=]+', 0)) = '{name}')[1]"
    value = f"regexp_replace({own}, '(?s)\\A[^\\s=]+\\s*=\\s*', '')"
    return f"coalesce(CASE WHEN left({value}, 1) IN ('''', '\"') THEN substr({value}, 2, length({value}) - 2) ELSE {value} END, '')"


def _unescaped_sql(text: str) -> str:
    number = "regexp_extract(p, '\\A&#0*([0-9]{1,7});?\\z', 1)"
    hexed = "regexp_extract(p, '\\A&#[xX]0*([0-9A-Fa-f]{1,6});?\\z', 1)"
    code = f"coalesce(TRY_CAST(nullif({number}, '') AS BIGINT), TRY_CAST('0x' || nullif({hexed}, '') AS BIGINT))"
    valid = f"({code} BETWEEN 1 AND 55295 OR {code} BETWEEN 57344 AND 1114111)"
    named = " ".join(f"WHEN {_lit(k)} THEN {_lit(v)}" for k, v in NAMED.items())
    one = f"CASE WHEN starts_with(p, '&#') THEN CASE WHEN {valid} THEN chr(CAST({code} AS INTEGER)) ELSE p END ELSE CASE lower(p) {named} ELSE p END END"
    return f"array_to_string(list_transform(regexp_extract_all({text}, {_lit(REFERENCE)}, 1), lambda p: {one}), '')"


_PATH = r"(?s)\A[^?]*"
_SITE = r"(?s)\A[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*"


def _resource_sql(url: str) -> str:
    return f"lower(regexp_extract({url}, '\\A[A-Za-z][A-Za-z0-9+.\\-]*://', 0)) || " + (
        f"regexp_extract({url}, {_lit(SITE)}, 2) || translate(regexp_extract({url}, {_lit(SITE)}, 3), "
        f"'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') || "
        f"substr(split_part({url}, '#', 1), length(regexp_extract({url}, {_lit(SITE)}, 0)) + 1)"
    )


def _resolve_sql(source: str, target: str, base: str, out: str) -> str:
    """Rows of ``source`` with ``out``: ``target`` as seen from ``base``, by the steps of ``resolve``."""
    step = "CASE WHEN s[1] = '..' THEN kept[1:len(kept) - 1] WHEN s[1] = '.' THEN kept ELSE list_concat(kept, s) END"
    segments = r"string_split(regexp_extract(_long, '(?s)\A[^?#]*', 0), '/')[2:]"
    kept = f"list_reduce(list_concat([CAST([] AS VARCHAR[])], list_transform({segments}, lambda x: [x])), lambda kept, s: {step})"
    return rf"""(SELECT * EXCLUDE (_site, _path, _query, _long, _kept), CASE
    WHEN regexp_matches({target}, '\A[A-Za-z][A-Za-z0-9+.\-]*:') THEN CASE WHEN contains({target}, '://') THEN {target} END
    WHEN _site = '' THEN NULL
    WHEN starts_with({target}, '//') THEN split_part(_site, '//', 1) || {target}
    WHEN starts_with({target}, '?') THEN _site || _path || {target}
    WHEN starts_with({target}, '#') THEN _site || _path || _query
    ELSE _site || '/' || array_to_string(_kept, '/') || CASE WHEN len(_kept) > 0 AND
      regexp_matches(regexp_extract(_long, '(?s)\A[^?#]*', 0), '/\.\.?\z') THEN '/' ELSE '' END ||
      regexp_extract(_long, '(?s)\A[^?#]*(.*)', 1) END AS {out}
  FROM (SELECT *, {kept} AS _kept FROM (SELECT *, CASE WHEN starts_with({target}, '/') THEN {target} WHEN _path = '' THEN '/' || {target}
      ELSE regexp_extract(_path, '(?s)\A(.*/)', 1) || {target} END AS _long
    FROM (SELECT *, regexp_extract({base}, '{_SITE}', 0) AS _site,
        regexp_extract(substr(split_part({base}, '#', 1), length(regexp_extract({base}, '{_SITE}', 0)) + 1), '{_PATH}', 0) AS _path,
        regexp_extract(split_part({base}, '#', 1), '(?s)\A[^?]*(.*)', 1) AS _query FROM {source}))))"""


_ATTRIBUTES = ", ".join(
    f"{_attribute_sql('tag', name)} AS {column}"
    for name, column in (("rel", "rel"), ("href", "href"), ("http-equiv", "equiv"), ("content", "content"))
)
_SAID = f"regexp_replace(regexp_replace(said, {_lit(DELAY)}, ''), {_lit(WORD)}, '')"
_LED = " || ".join(f"regexp_extract({_SAID}, {_lit(QUOTED)}, {k})" for k in (1, 2, 3))

SQL = rf"""
WITH RECURSIVE rules(host, path, action) AS (VALUES {_RULES}),
pages_in AS (SELECT page_id, url, html, row_number() OVER () AS row_id FROM pages),
tags AS (SELECT row_id, url, unnest(tags) AS tag, generate_subscripts(tags, 1) AS place FROM (
  SELECT row_id, url, regexp_extract_all(regexp_replace(html, {_lit(UNREAD)}, ' ', 'g'), {_lit(TAGS)}, 1) AS tags FROM pages_in
  WHERE url IS NOT NULL AND regexp_matches(html, '(?i)canonical|http-equiv'))),
attributes AS (SELECT row_id, url, place, lower(regexp_extract(tag, '\A[A-Za-z]+', 0)) AS kind, rel, {_unescaped_sql('href')} AS href,
  equiv, {_unescaped_sql('content')} AS said FROM (SELECT *, {_ATTRIBUTES} FROM tags)),
bases AS (SELECT row_id, url, arg_min(href, place) AS own FROM attributes WHERE kind = 'base' AND href <> '' GROUP BY ALL),
based AS (SELECT row_id, coalesce(base, url) AS base FROM {_resolve_sql('bases', 'own', 'url', 'base')}),
targets AS (SELECT t.url, coalesce(b.base, t.url) AS base, t.target FROM (
  SELECT row_id, url, regexp_replace(CASE
    WHEN kind = 'link' AND list_contains(regexp_split_to_array(lower({_unescaped_sql('rel')}), '\s+'), 'canonical') THEN href
    WHEN kind = 'meta' AND lower(trim(equiv)) = 'refresh' AND regexp_matches(said, {_lit(TARGETED)}) THEN {_LED}
    ELSE '' END, '\A\s+|\s+\z', '', 'g') AS target FROM attributes) t LEFT JOIN based b USING (row_id) WHERE t.target <> ''),
links AS (SELECT {_resource_sql('url')} AS a, {_resource_sql('b')} AS b FROM {_resolve_sql('targets', 'target', 'base', 'b')} WHERE b IS NOT NULL),
edges AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach(node, other) AS (SELECT a, b FROM edges UNION SELECT r.node, e.b FROM reach r JOIN edges e ON r.other = e.a),
urls AS (
  SELECT row_id, page_id, {_resource_sql('url')} AS node, url FROM pages_in
  UNION ALL SELECT NULL, NULL, a, a FROM (SELECT DISTINCT a FROM edges)),
parts AS (
  SELECT row_id, page_id, node,
    translate(coalesce(regexp_extract(url, '(?s)\A.*?://([^/?#]*)([^?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '(?s)\A.*?://([^/?#]*)([^?#]*)', 2), '') AS path FROM urls),
ranked AS (
  SELECT p.row_id, p.page_id, p.node, p.host, p.path, r.host || r.path AS rule, r.action,
    row_number() OVER (PARTITION BY p.row_id, p.node, p.host, p.path ORDER BY length(r.host || r.path) DESC NULLS LAST, r.action) AS k
  FROM parts p LEFT JOIN rules r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)),
best AS (SELECT * FROM ranked WHERE k = 1),
tainted AS (SELECT DISTINCT r.node FROM reach r JOIN best b ON r.other = b.node WHERE b.action = 'block')
SELECT page_id, host, path, rule,
  CASE WHEN action IS NOT NULL THEN action WHEN node IN (SELECT node FROM tainted) THEN 'block' ELSE 'allow' END AS verdict
FROM best WHERE row_id IS NOT NULL
"""


@query("op9_url_filter", SQL)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict for every page by the five rules and the links found in the pages."""
    pages = table(spark, sf_dir, "pages")
    return judge(pages, rule_table(spark), link_edges(pages))
