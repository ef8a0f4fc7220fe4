"""URL filters: host and path rules, and a path-template tree for what no rule decides.

Segments with digits become wildcards by their look (a file ending stays), so a table of distinct
templates is aggregated before anything else. Level by level, a node whose children are many and
each rare has them generalised to one wildcard. Sibling templates of a host that differ in one
segment, whichever has the most such siblings, are merged if their labelled purities fall in the
same Wilson class. Purity is smoothed along the tree: the corpus' rate is the host's prior, each
node's purity is its child's, so that labelled branches speak for siblings and children without
labels. A template is rejected if its purity is high. Labels are the rules' own verdicts unless
labels are given. Everything is DataFrame code.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize

#: verdict, host, path
RULES = (
    ("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"), ("block", "net", "/fr/"),
)
MANY_CHILDREN, FEW_EACH = 16, 4.0
PRIOR_WEIGHT, REJECT_PURITY = 5.0, 0.9
Z = 1.645

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = "(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, _PARTS, 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def rule_of(host: Column, path: Column, rules: tuple = RULES) -> tuple[Column, Column]:
    """(rule text, verdict) of the longest rule that fits, else nulls."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for v, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name, verdict = F.when(fits, h + p).otherwise(name), F.when(fits, v).otherwise(verdict)
    return name, verdict


def template(path: Column) -> Column:
    """Segments of the path, variable ones as *."""
    parts = F.filter(F.split(path, "/", -1), lambda s: s != "")
    return F.transform(parts, lambda s: F.when(s.rlike("[0-9]"), F.concat(F.lit("*"), F.regexp_extract(s, r"(\.[A-Za-z]{1,5})?$", 0))).otherwise(s))


def _wilson(bad: Column, n: Column, sign: int) -> Column:
    p = bad / n
    return (p + Z * Z / (2 * n) + sign * Z * F.sqrt(p * (1 - p) / n + Z * Z / (4 * n * n))) / (1 + Z * Z / n)


def tree(urls: DataFrame) -> DataFrame:
    """(host, look, purity) for every distinct host and template by look.

    urls: host, look array<string>, label (1 bad, 0 good, null unknown). purity is null-free.
    """
    leaves = materialize(
        urls.groupBy("host", "look").agg(F.count("*").alias("n"), F.count("label").alias("known"), F.coalesce(F.sum("label"), F.lit(0)).alias("bad"))
        .withColumn("t", F.col("look"))
    )
    d = 1
    # a node with many children needs as many templates that reach below it
    while leaves.where(F.size("t") >= d).limit(MANY_CHILDREN).count() == MANY_CHILDREN:
        at = F.slice("t", 1, d - 1)
        nodes = leaves.where(F.size("t") >= d).groupBy("host", at.alias("prefix"), F.element_at("t", d).alias("child")).agg(F.sum("n").alias("n"))
        wide = nodes.groupBy("host", "prefix").agg(F.count("*").alias("children"), F.sum("n").alias("n"))
        wide = wide.where(f"children >= {MANY_CHILDREN} and n < {FEW_EACH} * children").select("host", "prefix", F.lit(True).alias("wide"))
        joined = leaves.withColumn("prefix", at).join(materialize(wide), ["host", "prefix"], "left")
        rest = F.slice("t", F.lit(d + 1), F.greatest(F.size("t") - d, F.lit(0)))
        star = F.when(F.col("wide") & (F.size("t") >= d), F.concat(at, F.array(F.lit("*")), rest)).otherwise(F.col("t"))
        leaves = materialize(joined.select("host", "look", "n", "known", "bad", star.alias("t")))
        d += 1
    rate = F.coalesce(F.sum("bad") / F.nullif(F.sum("known"), F.lit(0)), F.lit(0.0))
    prior = float(leaves.agg(rate.alias("r")).first()[0])
    named = materialize(leaves.groupBy("host", "t").agg(F.sum("n").alias("n"), F.sum("known").alias("known"), F.sum("bad").alias("bad")))
    return leaves.select("host", "look", "t").join(_purity(named, prior), ["host", "t"]).select("host", "look", "purity")


def _purity(named: DataFrame, prior: float) -> DataFrame:
    """(host, t, purity) of templates (host, t, n, known, bad): merged siblings over the nodes above them."""
    sure = F.when(F.col("known") == 0, "none").when(_wilson(F.col("bad"), F.col("known"), -1) > 0.5, "bad").when(_wilson(F.col("bad"), F.col("known"), 1) < 0.5, "good").otherwise("open")
    # siblings: same host and class, and the same segments but for one
    holes = F.transform(F.filter(F.sequence(F.lit(1), F.size("t")), lambda i: ~F.element_at("t", i).startswith("*")), lambda i: F.struct(
        i.alias("hole"), F.md5(F.concat_ws("/", F.transform("t", lambda s, k: F.when(k == i - 1, F.lit("?")).otherwise(s)))).alias("family")))
    whole = F.struct(F.lit(0).alias("hole"), F.md5(F.concat_ws("/", "t")).alias("family"))
    each = named.withColumn("sure", sure).select("host", "t", "sure", "known", "bad", F.explode(F.concat(F.array(whole), F.when(F.size("t") > 0, holes).otherwise(F.array().cast("array<struct<hole:int,family:string>>")))).alias("h"))
    each = materialize(each.select("host", "t", "sure", "known", "bad", F.col("h.hole").alias("hole"), F.col("h.family").alias("family")))
    merged = materialize(each.groupBy("host", "sure", "hole", "family").agg(F.count("*").alias("siblings"), F.sum("known").alias("known"), F.sum("bad").alias("bad")))
    joined = each.drop("known", "bad").join(merged, ["host", "sure", "hole", "family"])
    # the place with the most siblings; of equals the first, none at all if nobody else is there
    own = joined.groupBy("host", "t").agg(F.max(F.struct("siblings", (-F.col("hole")).alias("first"), "known", "bad")).alias("m")).select("host", "t", F.col("m.known").alias("known"), F.col("m.bad").alias("bad"))
    # nodes above: the host is the first, the template's own last segment isn't among them
    above = named.select("host", "t", "known", "bad", F.posexplode(F.transform(F.sequence(F.lit(0), F.greatest(F.size("t") - 1, F.lit(0))), lambda i: F.md5(F.concat_ws("/", F.concat(F.array("host"), F.slice("t", F.lit(1), i)))))).alias("level", "node"))
    above = materialize(above)
    nodes = materialize(above.groupBy("host", "level", "node").agg(F.sum("known").alias("k"), F.sum("bad").alias("b")))
    chain = above.select("host", "t", "level", "node").join(nodes, ["host", "level", "node"]).groupBy("host", "t").agg(F.sort_array(F.collect_list(F.struct("level", "k", "b"))).alias("chain"))
    up = F.aggregate("chain", F.lit(prior), lambda p, x: (x["b"] + PRIOR_WEIGHT * p) / (x["k"] + PRIOR_WEIGHT))
    return own.join(chain, ["host", "t"]).select("host", "t", ((F.col("bad") + PRIOR_WEIGHT * up) / (F.col("known") + PRIOR_WEIGHT)).alias("purity"))


def judge(pages: DataFrame, url_col: str = "url", keep: tuple[str, ...] = (), rules: tuple = RULES, label_col: str | None = None) -> DataFrame:
    """The columns `keep`, host, path, rule, verdict and purity (null where a rule decides).

    Defined cases: null urls and those without :// have empty host and path and are judged like any
    other; paths of any depth are read whole; hosts without labels go by the corpus' rate; repeated
    rows stay repeated; an empty table gives an empty result; other columns aren't looked at.
    """
    url = F.col(url_col)
    parsed = pages.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(keep)], host_of(url).alias("host"), path_of(url).alias("path"), *([F.col(label_col).alias("_label")] if label_col else []))
    name, verdict = rule_of(F.col("host"), F.col("path"), rules)
    label = F.col("_label") if label_col else F.when(verdict == "block", 1).when(verdict == "allow", 0)
    parsed = parsed.withColumn("rule", name).withColumn("_verdict", verdict).withColumn("look", template(F.col("path"))).withColumn("label", label)
    purity = materialize(tree(parsed.select("host", "look", "label")))
    found = parsed.join(purity, ["host", "look"], "left")
    learnt = F.when(F.col("purity") >= REJECT_PURITY, "block").otherwise("allow")
    return found.select(
        *[F.col(f"_k{i}").alias(c) for i, c in enumerate(keep)], "host", "path", "rule", F.coalesce("_verdict", learnt).alias("verdict"),
        F.when(F.col("_verdict").isNull(), F.col("purity")).alias("purity"),
    )


def _levels(n: int) -> str:
    """SQL of the wildcards of many rare children at levels 1 to n."""
    out = []
    for d in range(1, n + 1):
        out.append(f"""wide{d} AS (
  SELECT host, prefix FROM (SELECT host, t[1:{d - 1}] AS prefix, t[{d}] AS child, sum(n) AS n FROM leaf{d - 1} WHERE len(t) >= {d} GROUP BY 1, 2, 3) GROUP BY host, prefix
  HAVING count(*) >= {MANY_CHILDREN} AND sum(n) < {FEW_EACH} * count(*)
), leaf{d} AS (
  SELECT l.* EXCLUDE (t), CASE WHEN w.host IS NOT NULL AND len(t) >= {d} THEN list_concat(list_concat(t[1:{d - 1}], ['*']), t[{d + 1}:]) ELSE t END AS t
  FROM leaf{d - 1} l LEFT JOIN wide{d} w ON w.host = l.host AND w.prefix = l.t[1:{d - 1}]
)""")
    return ",\n".join(out)


#: Levels of the SQL's tree.
SQL_LEVELS = 8
#: DuckDB SQL of the query over paths of up to SQL_LEVELS segments.
ORACLE = r"""
WITH parsed AS (
  SELECT page_id, translate(coalesce(regexp_extract(url, '^(?s:.*?)://([^/?#]*)([^?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '^(?s:.*?)://([^/?#]*)([^?#]*)', 2), '') AS path FROM pages
), ruled AS (
  SELECT *, CASE
    WHEN (host = 'www.example.com' OR host LIKE '%.www.example.com') AND starts_with(path, '/en/') THEN 'www.example.com/en/'
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/en/') THEN 'example.com/en/'
    WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/es/') THEN 'net/es/'
    WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/fr/') THEN 'net/fr/'
    WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/') THEN 'com/' END AS rule,
    list_transform(list_filter(string_split(path, '/'), lambda s: s <> ''),
      lambda s: CASE WHEN regexp_matches(s, '[0-9]') THEN '*' || regexp_extract(s, '(\.[A-Za-z]{1,5})?$', 0) ELSE s END) AS look
  FROM parsed
), marked AS (
  SELECT *, CASE WHEN rule IN ('example.com/en/', 'net/es/', 'net/fr/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow' END AS ruled FROM ruled
), leaf0 AS (
  SELECT host, look, count(*) AS n, count(ruled) AS known, count(*) FILTER (ruled = 'block') AS bad, look AS t FROM marked GROUP BY host, look
), """ + _levels(SQL_LEVELS) + rf""",
leaf AS (SELECT * FROM leaf{SQL_LEVELS}),
prior AS (SELECT coalesce(sum(bad) / nullif(sum(known), 0), 0.0) AS r FROM leaf),
named AS (SELECT host, t, sum(known) AS known, sum(bad) AS bad FROM leaf GROUP BY host, t),
classed AS (
  SELECT *, CASE WHEN known = 0 THEN 'none'
      WHEN (bad / known + 1.645 * 1.645 / (2 * known) - 1.645 * sqrt((bad / known) * (1 - bad / known) / known + 1.645 * 1.645 / (4 * known * known))) / (1 + 1.645 * 1.645 / known) > 0.5 THEN 'bad'
      WHEN (bad / known + 1.645 * 1.645 / (2 * known) + 1.645 * sqrt((bad / known) * (1 - bad / known) / known + 1.645 * 1.645 / (4 * known * known))) / (1 + 1.645 * 1.645 / known) < 0.5 THEN 'good'
      ELSE 'open' END AS sure
  FROM named
), holed AS (SELECT *, unnest(range(0, len(t) + 1)) AS hole FROM classed),
familied AS (
  SELECT *, list_transform(t, lambda s, i: CASE WHEN i = hole THEN '?' ELSE s END) AS family FROM holed WHERE hole = 0 OR NOT starts_with(t[hole], '*')
), merged AS (
  SELECT host, sure, hole, family, count(*) AS siblings, sum(known) AS k, sum(bad) AS b FROM familied GROUP BY 1, 2, 3, 4
), own AS (
  SELECT host, t, k, b FROM familied JOIN merged USING (host, sure, hole, family) QUALIFY row_number() OVER (PARTITION BY host, t ORDER BY siblings DESC, hole) = 1
), above AS (SELECT host, t, known, bad, unnest(range(0, greatest(len(t), 1))) AS level FROM named),
nodes AS (SELECT host, level, t[1:level] AS node, sum(known) AS k, sum(bad) AS b FROM above GROUP BY 1, 2, 3),
step AS (
  WITH RECURSIVE walk AS (
    SELECT host, t, -1 AS level, (SELECT r FROM prior) AS p FROM named UNION ALL
    SELECT w.host, w.t, w.level + 1, (n.b + 5.0 * w.p) / (n.k + 5.0) FROM walk w JOIN nodes n ON n.host = w.host AND n.level = w.level + 1 AND n.node = w.t[1:w.level + 1] WHERE w.level + 1 < greatest(len(w.t), 1)
  ) SELECT host, t, p FROM walk WHERE level = greatest(len(t), 1) - 1
), judged AS (SELECT host, t, (o.b + 5.0 * s.p) / (o.k + 5.0) AS purity FROM own o JOIN step s USING (host, t))
SELECT m.page_id, m.host, m.path, m.rule, coalesce(m.ruled, CASE WHEN j.purity >= 0.9 THEN 'block' ELSE 'allow' END) AS verdict
FROM marked m JOIN leaf l ON l.host = m.host AND l.look = m.look JOIN judged j ON j.host = l.host AND j.t = l.t
"""
