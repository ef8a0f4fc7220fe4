"""DuckDB SQL that the queries are checked against; every text starts from the same views."""

from __future__ import annotations

BASE = r"""
lines AS (
  SELECT l.l_orderkey, l.l_partkey, l.l_returnflag, l.l_quantity, p.p_type, p.p_brand, p.p_size, p.p_name
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
), detail AS (
  SELECT l_orderkey, CAST(sum(l_quantity) AS BIGINT) AS likes, list_sort(list_distinct(list('C0' || substr(p_brand, 7, 1)))) AS troubles,
    min({'k': l_partkey, 'o': '[' || p_brand || '] ' || lpad(CAST(p_size AS VARCHAR), 2, '0') || '호 ' || p_name}).o AS option
  FROM lines GROUP BY 1
), reviews AS (
  SELECT o_orderkey AS review_id, 'p' || lpad(CAST(o_orderkey % 10 AS VARCHAR), 3, '0') AS product_id, o_custkey AS author,
    o_orderpriority || ' ' || o_orderstatus || ' ' || strftime(o_orderdate, '%Y.%m') AS content, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS rating,
    strftime(o_orderdate, '%Y.%m.%d') AS review_date, strftime(o_orderdate, '%Y-%m') AS month,
    CASE WHEN c_mktsegment <> 'BUILDING' THEN c_mktsegment END AS skin_type, coalesce(troubles, []) AS troubles, option, coalesce(likes, 0) AS likes
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN detail ON o_orderkey = l_orderkey
), tags AS (
  SELECT l_orderkey AS review_id, p_type AS aspect, min(CASE l_returnflag WHEN 'A' THEN 'positive' WHEN 'R' THEN 'negative' ELSE 'neutral' END) AS polarity
  FROM lines GROUP BY 1, 2
), products AS (
  SELECT 'p' || lpad(CAST(n AS VARCHAR), 3, '0') AS product_id, CASE n % 3 WHEN 0 THEN 'single' WHEN 1 THEN 'separate' ELSE 'unobserved' END AS renewal_policy,
    CASE WHEN n % 3 = 1 AND n % 2 = 1 THEN '1999-11' END AS from_month, CASE WHEN n % 3 = 1 THEN '2001-03' END AS to_month
  FROM (SELECT DISTINCT o_orderkey % 10 AS n FROM orders)
), cut AS (SELECT strftime(max(o_orderdate) - INTERVAL 23 MONTH, '%Y-%m') AS m FROM (SELECT date_trunc('month', o_orderdate) AS o_orderdate FROM orders))
"""

SCORED = r"""
signals AS (
  SELECT r.*, substr(sha256(content), 1, 16) AS content_hash, length(content) AS content_length, count(*) OVER (PARTITION BY content) AS copies,
    round(sqrt(least(1.0, greatest(0.0, (length(content) - 22) / 456.0))), 6) AS s_length,
    round(percent_rank() OVER (PARTITION BY product_id ORDER BY likes), 6) AS s_likes,
    CASE WHEN review_id IN (SELECT review_id FROM tags) THEN 1.0 ELSE 0.0 END AS s_topic
  FROM {source} r
), scored AS (
  SELECT *, round(1.0 / copies, 6) AS s_unique, round((s_length * 0.6 + round(1.0 / copies, 6) * 0.4 + s_likes * 0.0 + s_topic * 0.5) / 1.5, 4) AS trust_score FROM signals
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY trust_score DESC, translate(replace(review_date, '.', '-'), '0123456789', '9876543210'), review_id) AS rank FROM scored
)
"""

IDENTITY = r"""
identity AS (
  SELECT r.*, CASE WHEN p.product_id IS NULL THEN 'product_mismatch'
      WHEN renewal_policy = 'separate' AND NOT ((from_month IS NULL OR month >= from_month) AND (to_month IS NULL OR month <= to_month)) THEN 'renewal_cut'
      WHEN month < (SELECT m FROM cut) THEN 'recency_cut' END AS reason, renewal_policy, from_month, to_month
  FROM reviews r LEFT JOIN products p USING (product_id)
)
"""

# One review of every product at a time, in rank order, with the keys kept so far.
WALK = r"""
passed AS (SELECT * EXCLUDE (reason, renewal_policy, from_month, to_month) FROM identity WHERE reason IS NULL), """ + SCORED.replace("{source}", "passed") + r""",
walk AS (
  SELECT product_id, CAST(0 AS BIGINT) AS rank, CAST(NULL AS VARCHAR) AS reason, CAST(NULL AS BIGINT) AS kept_rank, CAST([] AS VARCHAR[]) AS contents, CAST([] AS BIGINT[]) AS authors,
    CAST([] AS BIGINT[]) AS ranks FROM (SELECT DISTINCT product_id FROM ranked)
  UNION ALL
  SELECT r.product_id, r.rank,
    CASE WHEN list_contains(w.contents, r.content_hash) THEN 'duplicate_content' WHEN list_contains(w.authors, r.author) THEN 'same_author' END,
    CASE WHEN list_contains(w.contents, r.content_hash) THEN w.ranks[list_position(w.contents, r.content_hash)] WHEN list_contains(w.authors, r.author) THEN w.ranks[list_position(w.authors, r.author)] END,
    CASE WHEN list_contains(w.contents, r.content_hash) OR list_contains(w.authors, r.author) THEN w.contents ELSE list_append(w.contents, r.content_hash) END,
    CASE WHEN list_contains(w.contents, r.content_hash) OR list_contains(w.authors, r.author) THEN w.authors ELSE list_append(w.authors, r.author) END,
    CASE WHEN list_contains(w.contents, r.content_hash) OR list_contains(w.authors, r.author) THEN w.ranks ELSE list_append(w.ranks, r.rank) END
  FROM walk w JOIN ranked r ON r.product_id = w.product_id AND r.rank = w.rank + 1
), duplicate AS (
  SELECT r.*, w.reason, w.kept_rank FROM walk w JOIN ranked r USING (product_id, rank)
), kept AS (SELECT * EXCLUDE (reason, kept_rank) FROM duplicate WHERE reason IS NULL)
"""

CELLS = r"""
member AS (
  SELECT *, 'product' AS axis, 'None' AS segment FROM {source} UNION ALL
  SELECT *, 'skinType', coalesce(skin_type, '미기재') FROM {source} UNION ALL
  SELECT *, 'skinTrouble', unnest(CASE WHEN len(troubles) > 0 THEN troubles ELSE ['미기재'] END) FROM {source}
), sizes AS (SELECT product_id, axis, segment, count(DISTINCT author) AS cell_authors FROM member GROUP BY 1, 2, 3),
claims AS (
  SELECT m.product_id, m.axis, m.segment, t.aspect, count(DISTINCT CASE WHEN polarity = 'positive' THEN author END) AS pos,
    count(DISTINCT CASE WHEN polarity = 'negative' THEN author END) AS neg, count(DISTINCT CASE WHEN polarity = 'neutral' THEN author END) AS neu, count(DISTINCT author) AS spoke, any_value(s.cell_authors) AS cell_authors
  FROM member m JOIN tags t USING (review_id) JOIN sizes s USING (product_id, axis, segment) GROUP BY 1, 2, 3, 4
)
"""

JUDGED = CELLS.replace("{source}", "kept") + r""",
gate4 AS (
  SELECT *, pos + neg AS support, round(coalesce((pos + neg) / nullif(spoke, 0), 0.0), 4) AS share, cell_authors - spoke AS silent,
    CASE WHEN pos > 0 AND neg > 0 THEN 'mixed' WHEN pos > 0 THEN 'positive' WHEN neg > 0 THEN 'negative' ELSE 'neutral' END AS direction,
    CASE WHEN pos + neg > spoke OR spoke > cell_authors THEN 'invariant_broken' WHEN cell_authors < 8 THEN 'segment_too_small' WHEN pos + neg < 8 THEN 'insufficient_support' WHEN (pos + neg) / spoke < 0.10 THEN 'minority_share' END AS reason,
    product_id || '|' || axis || '=' || segment || '|' || aspect AS claim_id
  FROM claims
), judged AS (SELECT *, CASE WHEN reason IS NULL AND pos > 0 AND neg > 0 AND least(pos, neg) < 2 THEN 'single_dissent' END AS limitation FROM gate4)
"""

ALL = f"WITH RECURSIVE {BASE}, {IDENTITY}, {WALK}, {JUDGED}"
PLAIN = f"WITH {BASE}"
RANKED = f"WITH {BASE}, {SCORED.replace('{source}', 'reviews')}"
MEMBER = f"WITH {BASE}, {CELLS.replace('{source}', 'reviews')}"
RANKED_MEMBER = f"WITH {BASE}, {SCORED.replace('{source}', 'reviews')}, {CELLS.replace('{source}', 'ranked')}"

LEDGER = """
  SELECT 'identity' AS gate, 1 AS gate_order, reason, 'review' AS unit, CAST(review_id AS VARCHAR) AS subject FROM identity WHERE reason IS NOT NULL UNION ALL
  SELECT 'duplicate', 2, reason, 'review', CAST(review_id AS VARCHAR) FROM duplicate WHERE reason IS NOT NULL UNION ALL
  SELECT 'sufficiency', 4, reason, 'claim', claim_id FROM judged WHERE reason IS NOT NULL
"""

_LN = "lgamma({n} + 1) - lgamma({k} + 1) - lgamma({n} - {k} + 1)"


def _ln(n: str, k: str) -> str:
    return _LN.format(n=f"({n})", k=f"({k})")


def _binom(k: str, n: str, p: str) -> str:
    """P(X >= k) as a sum over all terms."""
    term = f"exp({_ln('CAST(' + n + ' AS DOUBLE)', 'CAST(i AS DOUBLE)')} + i * ln({p}) + ({n} - i) * ln(1 - {p}))"
    return f"least(1.0, list_sum(list_transform(range(CAST({k} AS BIGINT), CAST({n} AS BIGINT) + 1), lambda i: {term})))"


SUPPORT = f"""
counted AS (
  SELECT r.product_id, t.aspect, count(*) FILTER (polarity = 'positive') AS pos, count(*) FILTER (polarity = 'negative') AS neg, count(*) FILTER (polarity = 'neutral') AS neu
  FROM reviews r JOIN tags t USING (review_id) GROUP BY 1, 2
), tested AS (
  SELECT *, CASE WHEN pos > 0 AND neg > 0 THEN {_binom('least(pos, neg)', '(pos + neg)', '0.033')} ELSE 1.0 END AS p FROM counted
)
"""

CONFLICTS = r"""
told AS (
  SELECT r.review_id, r.rating, CASE WHEN rating <= 2 THEN 'negative' ELSE 'positive' END AS sentiment, t.aspect, t.polarity
  FROM reviews r JOIN tags t USING (review_id) WHERE rating <> 3 AND polarity <> 'neutral'
), conflicts AS (
  SELECT review_id, aspect, polarity AS tag_polarity, rating, sentiment AS rating_sentiment, CASE WHEN n = 1 THEN 'sole_aspect' WHEN against = n THEN 'all_aspects' ELSE 'minority_aspect' END AS kind
  FROM (SELECT *, count(*) OVER w AS n, count(*) FILTER (polarity <> sentiment) OVER w AS against FROM told WINDOW w AS (PARTITION BY review_id)) WHERE polarity <> sentiment
)
"""



def _table(x: str) -> str:
    """Probability of the 2 x 2 table with x in its first field and the margins of a, b, c, d."""
    return f"exp({_ln('a + b', x)} + {_ln('c + d', 'a + c - ' + x)} - ({_ln('a + b + c + d', 'a + c')}))"


SPLITS = f"""
stated AS (SELECT product_id, axis, aspect, segment, pos, neg FROM claims WHERE segment <> '미기재' AND axis <> 'product' AND pos + neg > 0),
pairs AS (
  SELECT l.product_id, l.axis, l.aspect, l.segment AS "left", r.segment AS "right", CAST(l.pos AS DOUBLE) AS a, CAST(l.neg AS DOUBLE) AS b, CAST(r.pos AS DOUBLE) AS c, CAST(r.neg AS DOUBLE) AS d
  FROM stated l JOIN stated r ON l.product_id = r.product_id AND l.axis = r.axis AND l.aspect = r.aspect AND l.segment < r.segment
), terms AS (
  SELECT *, list_transform(range(CAST(greatest(0, a - d) AS BIGINT), CAST(least(a + b, a + c) AS BIGINT) + 1), lambda x: {_table('x')}) AS probs,
    {_table('a')} * (1 + 1e-9) AS seen FROM pairs
), fisher AS (
  SELECT *, CASE WHEN a + b = 0 OR c + d = 0 OR a + c = 0 OR b + d = 0 THEN 1.0 ELSE least(1.0, list_sum(list_filter(probs, lambda q: q <= seen))) END AS p FROM terms
), splits AS (
  SELECT product_id, axis, aspect, "left", "right", round(p, 6) AS p_value, round(abs(b / (a + b) - d / (c + d)), 4) AS gap,
    coalesce(CASE WHEN b / (a + b) > 0.5 THEN 'n' WHEN b / (a + b) < 0.5 THEN 'p' END <> CASE WHEN d / (c + d) > 0.5 THEN 'n' WHEN d / (c + d) < 0.5 THEN 'p' END, false) AS flips,
    p < 0.05 AS split, CAST(b + d AS BIGINT) AS contradicting FROM fisher
)
"""

OPTIONS = r"""
forms AS (SELECT product_id, option, count(*) AS reviews FROM reviews WHERE option IS NOT NULL GROUP BY 1, 2),
parsed AS (
  SELECT *, regexp_extract_all(option, '[\[(]([^\])]*)[\])]?', 1) AS kept, regexp_replace(option, '[\[(]([^\])]*)[\])]?', '', 'g') AS rest FROM forms
), cored AS (
  SELECT *, regexp_replace(regexp_extract(trim(regexp_replace(regexp_replace(rest, '(?i)기획|단품|리필|본품|NEW|증정|어워즈|한정|에디션|단독|홀리데이|추천|베스트|콜라보|추가|수량|SET', ' ', 'g'), '[^0-9A-Za-z가-힣]+', ' ', 'g')), '^(\d{1,3})\s*호?\s*(\D.*)$', 2), '\s+', '', 'g') AS bare FROM parsed
), wrapping AS (
  SELECT product_id, trim(w) AS word FROM (SELECT product_id, bare, unnest(kept) AS w FROM cored) GROUP BY 1, 2 HAVING count(DISTINCT bare) >= 2
), extra AS (
  SELECT product_id, option, bare, trim(w) AS word FROM (SELECT product_id, option, bare, unnest(kept) AS w FROM cored) e
  WHERE NOT EXISTS (SELECT 1 FROM wrapping x WHERE x.product_id = e.product_id AND x.word = trim(e.w))
), known AS (
  SELECT DISTINCT product_id, bare FROM cored c WHERE NOT EXISTS (SELECT 1 FROM extra e WHERE e.product_id = c.product_id AND e.option = c.option)
), dropped AS (
  SELECT * FROM wrapping UNION SELECT product_id, word FROM extra e WHERE EXISTS (SELECT 1 FROM known k WHERE k.product_id = e.product_id AND k.bare = e.bare)
), whole AS (
  SELECT product_id, option, reviews, trim(regexp_replace(regexp_replace(array_to_string(list_append(list_filter(kept, lambda w: NOT list_contains(coalesce(words, []), trim(w))), rest), ' '), '(?i)기획|단품|리필|본품|NEW|증정|어워즈|한정|에디션|단독|홀리데이|추천|베스트|콜라보|추가|수량|SET', ' ', 'g'), '[^0-9A-Za-z가-힣]+', ' ', 'g')) AS t
  FROM cored c LEFT JOIN (SELECT product_id, list(word) AS words FROM dropped GROUP BY 1) USING (product_id)
), named AS (
  SELECT product_id, option, reviews, CASE WHEN regexp_matches(t, '^(\d{1,3})\s*호?\s*(\D.*)$') THEN regexp_replace(regexp_extract(t, '^(\d{1,3})', 1), '^0+(\d)', '\1') END AS number,
    regexp_replace(CASE WHEN regexp_matches(t, '^(\d{1,3})\s*호?\s*(\D.*)$') THEN regexp_extract(t, '^(\d{1,3})\s*호?\s*(\D.*)$', 2) ELSE t END, '\s+', '', 'g') AS name FROM whole
), single AS (SELECT product_id, name, min(number) AS sole FROM named WHERE number IS NOT NULL GROUP BY 1, 2 HAVING count(DISTINCT number) = 1),
options AS (
  SELECT n.product_id, option, reviews, CASE WHEN n.name = '' THEN 'pack' ELSE 'shade' END AS kind,
    CASE WHEN n.name <> '' THEN CASE WHEN coalesce(number, sole) IS NOT NULL THEN coalesce(number, sole) || '|' || n.name ELSE n.name END END AS shade_key
  FROM named n LEFT JOIN single s ON s.product_id = n.product_id AND s.name = n.name
)
"""

QUOTES = r"""
quoted AS (
  SELECT m.product_id, m.axis, m.segment, t.aspect, m.review_id, t.polarity,
    row_number() OVER (PARTITION BY m.product_id, axis, segment, aspect ORDER BY trust_score DESC, translate(replace(review_date, '.', '-'), '0123456789', '9876543210'), review_id) AS quote_rank,
    row_number() OVER (PARTITION BY m.product_id, axis, segment, aspect, polarity ORDER BY trust_score DESC, translate(replace(review_date, '.', '-'), '0123456789', '9876543210'), review_id) AS polarity_rank
  FROM member m JOIN tags t USING (review_id)
)
"""

# The turns written out one after the other: a state of the three counts, and who was promoted.
KEPT = r"""
state0 AS (
  SELECT product_id, axis, segment, aspect, count(*) FILTER (quote_rank <= 8 AND polarity = 'negative') AS n, count(*) FILTER (quote_rank <= 8 AND polarity = 'neutral') AS u,
    count(*) FILTER (quote_rank <= 8 AND polarity = 'positive') AS p, bool_or(polarity = 'negative') AS tn, bool_or(polarity = 'neutral') AS tu, bool_or(polarity = 'positive') AS tp
  FROM quoted GROUP BY 1, 2, 3, 4
), state1 AS (
  SELECT *, tn AND n = 0 AS gn, CASE WHEN tn AND n = 0 THEN 1 ELSE n END AS n1, CASE WHEN tn AND n = 0 AND u >= p THEN u - 1 ELSE u END AS u1, CASE WHEN tn AND n = 0 AND u < p THEN p - 1 ELSE p END AS p1 FROM state0
), state2 AS (
  SELECT *, tu AND u1 = 0 AS gu, CASE WHEN tu AND u1 = 0 THEN 1 ELSE u1 END AS u2, CASE WHEN tu AND u1 = 0 AND n1 >= p1 THEN n1 - 1 ELSE n1 END AS n2, CASE WHEN tu AND u1 = 0 AND n1 < p1 THEN p1 - 1 ELSE p1 END AS p2 FROM state1
), state3 AS (
  SELECT *, tp AND p2 = 0 AS gp, CASE WHEN tp AND p2 = 0 THEN 1 ELSE p2 END AS p3, CASE WHEN tp AND p2 = 0 AND n2 >= u2 THEN n2 - 1 ELSE n2 END AS n3, CASE WHEN tp AND p2 = 0 AND n2 < u2 THEN u2 - 1 ELSE u2 END AS u3 FROM state2
), keeping AS (
  SELECT q.product_id, q.axis, q.segment, q.aspect, review_id, polarity, quote_rank, CASE polarity WHEN 'negative' THEN gn WHEN 'neutral' THEN gu ELSE gp END AS reserved
  FROM quoted q JOIN state3 s ON s.product_id = q.product_id AND s.axis = q.axis AND s.segment = q.segment AND s.aspect = q.aspect
  WHERE polarity_rank <= CASE polarity WHEN 'negative' THEN n3 WHEN 'neutral' THEN u3 ELSE p3 END
)
"""

VERDICTS = r"""
evidence AS (
  SELECT doc_id AS quote_id, CASE WHEN doc_id % 4 = 3 THEN doc_id + 1000000000 ELSE doc_id END AS review_id,
    CASE doc_id % 4 WHEN 1 THEN replace(text, chr(10), ' ') WHEN 2 THEN replace(text, ' ', '') ELSE text END AS quote FROM documents
  UNION ALL SELECT item_id + 2000000000, item_id, text FROM benchmark
), own AS (
  SELECT e.*, CASE WHEN regexp_replace(coalesce(quote, ''), '\s+', '', 'g') = '' THEN 'blank_quote' WHEN d.doc_id IS NULL THEN 'unknown_review' WHEN contains(d.text, quote) THEN 'verbatim'
    WHEN contains(trim(regexp_replace(d.text, '[ \n]+', ' ', 'g')), trim(regexp_replace(quote, '[ \n]+', ' ', 'g'))) THEN 'linebreak_only'
    WHEN contains(regexp_replace(d.text, '\s+', '', 'g'), regexp_replace(quote, '\s+', '', 'g')) THEN 'spacing_edited' END AS s
  FROM evidence e LEFT JOIN documents d ON d.doc_id = e.review_id
), elsewhere AS (SELECT o.quote_id, min(d.doc_id) AS matched_review_id FROM own o JOIN documents d ON contains(d.text, o.quote) AND d.doc_id <> o.review_id WHERE o.s IS NULL GROUP BY 1),
verdicts AS (
  SELECT o.quote_id, o.review_id, coalesce(s, CASE WHEN matched_review_id IS NOT NULL THEN 'misattributed' ELSE 'fabricated' END) AS status, matched_review_id FROM own o LEFT JOIN elsewhere USING (quote_id)
)
"""

RAW_TAGS = r"""
raw AS (
  SELECT review_id, ord, min({'a': aspect, 'p': polarity, 's': snippet}) AS x FROM (
    SELECT l_orderkey AS review_id, lpad(CAST(l_partkey AS VARCHAR), 9, '0') || '-' || lpad(CAST(l_linenumber AS VARCHAR), 3, '0') || '-' || lpad(CAST(l_suppkey AS VARCHAR), 9, '0') || '-' || lpad(printf('%.2f', l_extendedprice), 15, '0') AS ord,
      CASE WHEN l_linenumber = 7 THEN 'other' ELSE p_type END AS aspect,
      CASE WHEN l_linenumber = 6 AND l_linestatus = 'F' THEN 'unsure' WHEN l_returnflag = 'A' THEN 'positive' WHEN l_returnflag = 'R' THEN 'negative' ELSE 'neutral' END AS polarity,
      CASE WHEN l_linestatus = 'O' THEN '-' ELSE 'zzz' END AS snippet
    FROM lineitem JOIN part ON l_partkey = p_partkey) GROUP BY 1, 2
), based AS (
  SELECT w.review_id, ord, x.a AS aspect, CASE WHEN r.content IS NULL THEN 'unknown_review' WHEN x.a NOT IN ('ECONOMY', 'STANDARD', 'PROMO', 'MEDIUM', 'SMALL', 'LARGE') THEN 'unknown_aspect'
    WHEN x.p = 'unsure' THEN 'unknown_polarity' WHEN NOT contains(r.content, x.s) THEN 'not_verbatim' END AS base FROM raw w LEFT JOIN reviews r USING (review_id)
), again AS (SELECT *, row_number() OVER (PARTITION BY review_id, aspect, base IS NULL ORDER BY ord) > 1 AS again FROM based),
placed AS (SELECT *, count(*) FILTER (base IS NULL AND NOT again) OVER (PARTITION BY review_id ORDER BY ord ROWS UNBOUNDED PRECEDING) AS place FROM again)
"""

BRIDGE = r"""
bridge AS (
  SELECT 'A' || lpad(CAST(s_suppkey // 3 AS VARCHAR), 12, '0') AS goods_no, 'p' || CAST(s_suppkey AS VARCHAR) AS product_id,
    CASE s_suppkey % 3 WHEN 1 THEN '1998-01' WHEN 2 THEN '2000-01' END AS from_month, CASE s_suppkey % 3 WHEN 0 THEN '1997-12' WHEN 1 THEN '1999-12' END AS to_month FROM supplier
)
"""

CONFIDENCE = r"""
confidence AS (
  SELECT claim_id, CASE WHEN axis = 'product' THEN 'unconditional' ELSE 'conditional' END AS claim_type, reason AS failure_reason, reason IS NULL AS exposable,
    concat_ws(',', CASE WHEN direction = 'mixed' THEN 'mixed_direction' END, CASE WHEN silent / nullif(silent + spoke, 0) >= 0.5 THEN 'mostly_silent' END,
      CASE WHEN support < 8 THEN 'few_authors' END, CASE WHEN limitation IS NOT NULL THEN 'limited' END) AS hedges FROM judged
), banded AS (SELECT *, CASE WHEN hedges <> '' THEN 'hedged' ELSE 'assertive' END AS band FROM confidence)
"""

TRACE = r"""
targets AS (
  SELECT r.review_id AS key, product_id, 'skinType' AS axis, coalesce(skin_type, 'none') AS segment, coalesce(t.aspect, 'nothing') AS aspect,
    CASE WHEN rating <= 2 THEN 'negative' WHEN rating >= 4 THEN 'positive' ELSE 'neutral' END AS want
  FROM reviews r LEFT JOIN (SELECT review_id, min(aspect) AS aspect FROM tags GROUP BY 1) t USING (review_id)
), traced AS (
  SELECT t.key, CASE WHEN t.aspect = 'nothing' THEN 'untraceable' WHEN j.claim_id IS NULL THEN 'no_candidate' WHEN j.reason IS NOT NULL THEN 'rejected' ELSE 'produced' END AS outcome,
    CASE WHEN t.aspect = 'nothing' THEN NULL WHEN s.cell_authors IS NULL THEN 'identity' WHEN j.claim_id IS NULL THEN 'polarity' WHEN j.reason IS NOT NULL THEN 'sufficiency' END AS gate,
    CASE WHEN t.aspect = 'nothing' THEN 'aspect_outside_taxonomy' WHEN s.cell_authors IS NULL THEN 'empty_cell' WHEN j.claim_id IS NULL THEN 'no_tagged_mention' ELSE j.reason END AS reason,
    CASE WHEN j.claim_id IS NOT NULL AND j.reason IS NULL THEN j.direction = t.want END AS direction_match
  FROM targets t LEFT JOIN sizes s ON s.product_id = t.product_id AND s.axis = t.axis AND s.segment = t.segment
  LEFT JOIN judged j ON j.product_id = t.product_id AND j.axis = t.axis AND j.segment = t.segment AND j.aspect = t.aspect
)
"""

QUOTED = """quoted AS (
  SELECT quote_id // 5 AS claim_id, CAST(quote_id % 5 AS INTEGER) AS position, quote_id, CASE WHEN quote_id % 5 >= 3 AND (quote_id // 5) % 3 = 0 THEN quote_id // 5 * 5 ELSE review_id END AS review_id, status, matched_review_id,
    quote_id % 5 >= 3 AS spare FROM verdicts
)"""


def quote_walk(most: int) -> str:
    """The quote gate over the rows of quoted: one spare after the other, with the reviews in use; at most `most` are taken."""
    return f"""
claimed AS (
  SELECT claim_id, count(*) FILTER (NOT spare) AS wanted, coalesce(list(review_id) FILTER (NOT spare AND status = 'verbatim'), []) AS used, least(count(*) FILTER (NOT spare AND status <> 'verbatim'), {most}) AS budget FROM quoted GROUP BY 1
), spares AS (SELECT *, row_number() OVER (PARTITION BY claim_id ORDER BY position) AS i FROM quoted WHERE spare),
steps AS (
  SELECT claim_id, CAST(0 AS BIGINT) AS i, used, CAST(0 AS BIGINT) AS taken, CAST(NULL AS VARCHAR) AS fate, CAST(NULL AS INTEGER) AS position FROM claimed
  UNION ALL
  SELECT s.claim_id, s.i, CASE WHEN w.taken < o.budget AND NOT list_contains(w.used, s.review_id) AND s.status = 'verbatim' THEN list_append(w.used, s.review_id) ELSE w.used END,
    CASE WHEN w.taken < o.budget AND NOT list_contains(w.used, s.review_id) AND s.status = 'verbatim' THEN w.taken + 1 ELSE w.taken END,
    CASE WHEN w.taken >= o.budget THEN 'not_reached' WHEN list_contains(w.used, s.review_id) THEN 'used_review' WHEN s.status = 'verbatim' THEN 'substituted' ELSE 'dropped' END, s.position
  FROM steps w JOIN spares s ON s.claim_id = w.claim_id AND s.i = w.i + 1 JOIN claimed o ON o.claim_id = w.claim_id
), fated AS (
  SELECT q.*, CASE WHEN q.spare THEN t.fate WHEN q.status = 'verbatim' THEN 'kept' ELSE 'dropped' END AS fate FROM quoted q LEFT JOIN steps t ON t.claim_id = q.claim_id AND t.position = q.position AND q.spare AND t.i > 0
), walked AS (
  SELECT *, CASE WHEN fate IN ('kept', 'substituted') THEN CAST(count(*) FILTER (fate IN ('kept', 'substituted')) OVER (PARTITION BY claim_id ORDER BY spare, position) AS INTEGER) END AS kept_order FROM fated
), outcomes AS (
  SELECT *, CASE WHEN kept < 1 THEN 'discarded' WHEN dropped = 0 THEN 'clean' WHEN substituted > 0 THEN 'substituted' ELSE 'reduced' END AS outcome FROM (
    SELECT claim_id, CAST(count(*) FILTER (NOT spare) AS INTEGER) AS evidence, CAST(count(kept_order) AS INTEGER) AS kept, CAST(count(*) FILTER (fate = 'dropped') AS INTEGER) AS dropped, CAST(count(*) FILTER (fate = 'substituted') AS INTEGER) AS substituted FROM walked GROUP BY 1)
)"""


# Segments that pass the sufficiency gate, compared within an axis; of each split pair the smaller side, if its majority isn't the other's.
UNCONDITIONAL = f"""
seg AS (
  SELECT *, segment <> '미기재' AS stated, cell_authors >= 8 AND pos + neg >= 8 AND (pos + neg) / spoke >= 0.10 AND pos + neg <= spoke AND spoke <= cell_authors AS enough FROM claims WHERE axis <> 'product'
), usable AS (SELECT product_id, aspect, axis, segment, pos, neg, CASE WHEN neg > pos THEN 'n' WHEN pos > neg THEN 'p' END AS major FROM seg WHERE stated AND enough),
both_sides AS (
  SELECT l.product_id, l.aspect, l.axis, l.segment AS s1, r.segment AS s2, CAST(l.pos AS DOUBLE) AS a, CAST(l.neg AS DOUBLE) AS b, CAST(r.pos AS DOUBLE) AS c, CAST(r.neg AS DOUBLE) AS d, l.major AS m1, r.major AS m2
  FROM usable l JOIN usable r ON l.product_id = r.product_id AND l.axis = r.axis AND l.aspect = r.aspect AND l.segment < r.segment
), chances AS (
  SELECT *, list_transform(range(CAST(greatest(0, a - d) AS BIGINT), CAST(least(a + b, a + c) AS BIGINT) + 1), lambda x: {_table('x')}) AS probs, {_table('a')} * (1 + 1e-9) AS seen FROM both_sides
), compared AS (
  SELECT *, CASE WHEN a + c = 0 OR b + d = 0 THEN 1.0 ELSE least(1.0, list_sum(list_filter(probs, lambda q: q <= seen))) END < 0.05 AS split FROM chances
), covered AS (
  SELECT product_id, aspect, axis, s1 AS segment, CASE m1 WHEN 'n' THEN b ELSE a END AS authors FROM compared WHERE split AND m1 IS NOT NULL AND m1 IS DISTINCT FROM m2 AND a + b < c + d UNION ALL
  SELECT product_id, aspect, axis, s2, CASE m2 WHEN 'n' THEN d ELSE c END FROM compared WHERE split AND m2 IS NOT NULL AND m2 IS DISTINCT FROM m1 AND c + d < a + b
), lost AS (SELECT product_id, aspect, sum(w) AS w FROM (SELECT product_id, aspect, axis, segment, max(authors) AS w FROM covered GROUP BY ALL) GROUP BY ALL),
unconditional AS (
  SELECT s.product_id, s.aspect, coalesce(c.n, 0) AS compared, coalesce(c.k, 0) AS splits, coalesce(c.f, 0) AS flips, CAST(coalesce(l.w, 0) AS BIGINT) AS contradicting_authors, s.u AS skipped_unstated, s.i AS skipped_insufficient,
    coalesce(c.k, 0) = 0 AS holds, CASE WHEN c.k > 0 THEN 'missing_condition' END AS failure
  FROM (SELECT product_id, aspect, count(*) FILTER (NOT stated) AS u, count(*) FILTER (stated AND NOT enough) AS i FROM seg GROUP BY ALL) s
  LEFT JOIN (SELECT product_id, aspect, count(*) AS n, count(*) FILTER (split) AS k, count(*) FILTER (split AND m1 IS NOT NULL AND m2 IS NOT NULL AND m1 <> m2) AS f FROM compared GROUP BY ALL) c USING (product_id, aspect) LEFT JOIN lost l USING (product_id, aspect)
)"""

QUERIES = {
    "flagship": f"{ALL} SELECT product_id, axis, segment, aspect, pos, neg, neu, spoke, cell_authors, silent, direction, support, share, reason, limitation FROM judged",
    "ingest_records": f"""{PLAIN} SELECT review_id, product_id, CAST(author AS VARCHAR) AS author_key, substr(sha256(content), 1, 16) AS content_hash, CAST(length(content) AS INTEGER) AS content_length,
      CASE WHEN rating <= 2 THEN 'negative' WHEN rating >= 4 THEN 'positive' ELSE 'neutral' END AS sentiment_prior, month AS review_month, coalesce(skin_type, '미기재') AS skin_segment,
      skin_type IS NOT NULL AS skin_stated, CASE WHEN len(troubles) > 0 THEN array_to_string(troubles, ',') ELSE '미기재' END AS trouble_segments FROM reviews""",
    "trust_scores": f"{RANKED} SELECT review_id, product_id, CAST(content_length AS INTEGER) AS content_length, copies, s_length, s_unique, CAST(s_topic AS DOUBLE) AS s_topic, s_likes, trust_score, 'hasPhoto,usagePeriod' AS unavailable FROM ranked",
    "trust_rank": f"{RANKED} SELECT product_id, review_id, CAST(rank AS BIGINT) AS rank FROM ranked",
    "identity_gate": f"""WITH {BASE}, {IDENTITY} SELECT review_id, product_id, month, reason,
      CASE reason WHEN 'renewal_cut' THEN month || ' outside ' || coalesce(from_month, '') || '..' || coalesce(to_month, '') WHEN 'recency_cut' THEN month || ' before ' || (SELECT m FROM cut) END AS detail,
      CASE WHEN reason IS NULL AND renewal_policy = 'unobserved' THEN 'renewal_unobserved' END AS limitation FROM identity""",
    "duplicate_gate": f"{ALL} SELECT product_id, review_id, CAST(rank AS BIGINT) AS rank, reason, CAST(kept_rank AS BIGINT) AS kept_rank FROM duplicate",
    "cell_sizes": f"{MEMBER} SELECT * FROM sizes",
    "candidate_claims": f"{MEMBER} SELECT product_id || '|' || axis || '=' || segment || '|' || aspect AS claim_id, * FROM claims",
    "ledger_rows": f"{ALL} {LEDGER}",
    "ledger_rollup": f"{ALL}, ledger AS ({LEDGER}) SELECT gate, reason, count(*) AS n FROM ledger GROUP BY ROLLUP (gate, reason)",
    "gate_summary": f"""{ALL} SELECT 'identity' AS gate, count(*) AS reviews, count(*) FILTER (reason IS NULL) AS passed, count(*) FILTER (reason IS NULL AND renewal_policy = 'unobserved') AS limited FROM identity UNION ALL
      SELECT 'duplicate', count(*), count(*) FILTER (reason IS NULL), 0 FROM duplicate UNION ALL SELECT 'sufficiency', count(*), count(*) FILTER (reason IS NULL), count(limitation) FROM judged""",
    "aspect_support": f"""{PLAIN}, {SUPPORT} SELECT t.product_id, aspect, pos, neg, neu, (SELECT count(*) FROM reviews r WHERE r.product_id = t.product_id) - pos - neg - neu AS silent,
      CASE WHEN pos > 0 AND neg > 0 THEN 'mixed' WHEN pos > 0 THEN 'positive' WHEN neg > 0 THEN 'negative' ELSE 'neutral' END AS direction,
      CASE WHEN pos > 0 AND neg > 0 THEN 'mixed' WHEN pos > 0 THEN 'positive' WHEN neg > 0 THEN 'negative' WHEN neu > 0 THEN 'neutral_only' ELSE 'silent' END AS verdict,
      round(neg / nullif(pos + neg, 0), 4) AS negative_ratio, round(p, 6) AS minority_p,
      concat_ws(',', CASE WHEN pos > 0 AND neg > 0 AND p >= 0.05 THEN 'minority_within_tagger_noise' END, CASE WHEN pos + neg > 0 THEN 'tagger_direction_error' END) AS limitations FROM tested t""",
    "noise_threshold": f"""{MEMBER}, sizes_of AS (SELECT DISTINCT pos + neg AS n FROM claims WHERE pos + neg > 0), tries AS (SELECT n, unnest(range(1, n + 1)) AS k FROM sizes_of)
      SELECT n, min(k) AS min_minority FROM tries WHERE k <= n * 0.2 + 12 AND {_binom('k', 'n', '0.033')} < 0.05 GROUP BY n""",
    "rating_conflicts": f"{PLAIN}, {CONFLICTS} SELECT * FROM conflicts",
    "conflicts_by_kind": f"{PLAIN}, {CONFLICTS} SELECT kind, count(*) AS n FROM conflicts GROUP BY 1",
    "segment_splits": f"{MEMBER}, {SPLITS} SELECT * FROM splits",
    "unconditional_check": f"""{MEMBER}, {UNCONDITIONAL} SELECT * FROM unconditional""",
    "option_index": f"{PLAIN}, {OPTIONS} SELECT * FROM options",
    "shade_counts": f"{PLAIN}, {OPTIONS} SELECT product_id, shade_key, CAST(sum(reviews) AS BIGINT) AS reviews, count(*) AS forms FROM options WHERE shade_key IS NOT NULL GROUP BY 1, 2",
    "ranked_quotes": f"{RANKED_MEMBER}, {QUOTES} SELECT product_id, axis, segment, aspect, review_id, polarity, CAST(quote_rank AS BIGINT) AS quote_rank, CAST(polarity_rank AS BIGINT) AS polarity_rank FROM quoted",
    "kept_quotes": f"{RANKED_MEMBER}, {QUOTES}, {KEPT} SELECT product_id, axis, segment, aspect, review_id, polarity, CAST(quote_rank AS BIGINT) AS quote_rank, reserved FROM keeping",
    "evidence_months": f"{MEMBER} SELECT product_id, axis, segment, aspect, min(month) AS first_month, max(month) AS last_month, count(*) AS quotes FROM member JOIN tags USING (review_id) GROUP BY 1, 2, 3, 4",
    "quote_verdicts": f"WITH {VERDICTS} SELECT * FROM verdicts",
    "quote_summary": f"WITH {VERDICTS} SELECT status, count(*) AS n, round(100.0 * count(*) / (SELECT count(*) FROM verdicts), 1) AS percent FROM verdicts GROUP BY 1",
    "quote_outcomes": f"WITH RECURSIVE {VERDICTS}, {QUOTED}, {quote_walk(99)} SELECT * FROM outcomes",
    "quote_walk": f"WITH RECURSIVE {VERDICTS}, {QUOTED}, {quote_walk(99)} SELECT claim_id, position, review_id, status, fate, kept_order FROM walked",
    "quote_ledger": f"""WITH RECURSIVE {VERDICTS}, {QUOTED}, {quote_walk(99)}
      SELECT 'evidence' AS unit, claim_id, CASE status WHEN 'misattributed' THEN 'quote_misattributed' ELSE 'quote_not_verbatim' END AS reason, CASE status WHEN 'misattributed' THEN '출처불일치' ELSE '인용불일치' END AS label,
        status, review_id, quote_id, matched_review_id, CAST(NULL AS INTEGER) AS kept, CAST(NULL AS INTEGER) AS needed FROM walked WHERE fate = 'dropped' UNION ALL
      SELECT 'claim', claim_id, 'no_verbatim_evidence', '근거소진', NULL, NULL, NULL, NULL, kept, 1 FROM outcomes WHERE outcome = 'discarded'""",
    "quote_gate_summary": f"""WITH RECURSIVE {VERDICTS}, {QUOTED}, {quote_walk(99)}, j AS (SELECT count(*) AS n, count(*) FILTER (status = 'verbatim') AS v, count(*) FILTER (fate = 'dropped') AS x FROM walked WHERE fate IN ('kept', 'dropped', 'substituted'))
      SELECT count(*) AS claims, any_value(n) AS quotes_checked, any_value(v) AS quotes_verbatim, round(100.0 * any_value(v) / any_value(n), 1) AS verbatim_percent, count(*) FILTER (outcome = 'clean') AS clean,
        count(*) FILTER (outcome = 'reduced') AS reduced, count(*) FILTER (outcome = 'substituted') AS substituted, count(*) FILTER (outcome = 'discarded') AS discarded, any_value(x) + count(*) FILTER (outcome = 'discarded') AS ledger_rows FROM outcomes, j""",
    "folded_texts": r"""WITH odd AS (SELECT doc_id, chr(65279) || replace(text, chr(10), chr(13) || chr(10)) || chr(8203) || chr(160) || chr(12288) || 'e' || chr(769) AS t FROM documents),
      f AS (SELECT doc_id, regexp_replace(replace(replace(regexp_replace(nfc_normalize(t), '\r\n?', chr(10), 'g'), chr(8203), ''), chr(65279), ''), '\p{Zs}', ' ', 'g') AS f FROM odd)
      SELECT doc_id, CAST(length(f) AS INTEGER) AS folded_length, md5(f) AS folded_md5, CAST(length(regexp_replace(f, '\s+', '', 'g')) AS INTEGER) AS squeezed_length,
        CAST(length(trim(regexp_replace(f, '[ \n]+', ' ', 'g'))) AS INTEGER) AS one_line_length FROM f""",
    "tag_partition": f"{PLAIN}, {RAW_TAGS} SELECT ord, review_id, aspect, coalesce(base, CASE WHEN again THEN 'duplicate_aspect' WHEN place > 5 THEN 'too_many_aspects' END) AS violation FROM placed",
    "review_contract": f"""{PLAIN}, r AS (SELECT review_id, CASE WHEN review_id % 10 = 3 THEN 9 ELSE rating END AS rating, CASE WHEN review_id % 7 = 1 THEN '1999/13' ELSE review_date END AS review_date FROM reviews),
      a AS (SELECT * FROM r UNION ALL SELECT * FROM r WHERE review_id = 5)
      SELECT review_id, 'rating_range' AS violation FROM a WHERE rating NOT BETWEEN 1 AND 5 UNION ALL SELECT review_id, 'bad_date' FROM a WHERE review_date = '1999/13' UNION ALL
      SELECT review_id, 'duplicate_id' FROM a GROUP BY 1 HAVING count(*) > 1""",
    "code_coverage": f"""{PLAIN}, used AS (SELECT code, count(*) AS uses FROM (SELECT unnest(troubles) AS code FROM reviews) GROUP BY 1), book AS (SELECT 'C0' || CAST(i + 1 AS VARCHAR) AS code FROM range(1, 9) t(i))
      SELECT coalesce(u.code, b.code) AS code, coalesce(uses, 0) AS uses, CASE WHEN b.code IS NULL THEN 'unknown' WHEN uses IS NULL THEN 'unused' ELSE 'known' END AS state FROM used u FULL JOIN book b ON u.code = b.code""",
    "resolved_goods": f"""{PLAIN}, {BRIDGE}, bought AS (SELECT l_orderkey, 'A' || lpad(CAST(min(l_suppkey) // 3 AS VARCHAR), 12, '0') AS goods_no FROM lineitem GROUP BY 1),
      rows AS (SELECT review_id, goods_no, month FROM reviews JOIN bought ON review_id = l_orderkey), owned AS (SELECT *, count(*) OVER (PARTITION BY goods_no) AS owners FROM bridge),
      hits AS (SELECT review_id, count(*) AS matches, min(product_id) AS product_id FROM rows JOIN owned USING (goods_no) WHERE owners = 1 OR ((from_month IS NULL OR month >= from_month) AND (to_month IS NULL OR month <= to_month)) GROUP BY 1)
      SELECT r.review_id, goods_no, month, product_id, coalesce(matches, 0) AS matches FROM rows r LEFT JOIN hits USING (review_id)""",
    "overlapping_ranges": f"""WITH {BRIDGE}, late AS (SELECT goods_no, product_id, from_month, CASE WHEN to_month = '1999-12' THEN '2000-06' ELSE to_month END AS to_month FROM bridge)
      SELECT a.goods_no, a.product_id AS a_product_id, b.product_id AS b_product_id FROM late a JOIN late b ON a.goods_no = b.goods_no AND a.product_id < b.product_id
      WHERE coalesce(a.from_month, '0000') <= coalesce(b.to_month, '9999') AND coalesce(b.from_month, '0000') <= coalesce(a.to_month, '9999')""",
    "dependent_reviews": f"""{PLAIN} SELECT product_id, 'author' AS kind, n FROM (SELECT product_id, author, count(*) AS n FROM reviews GROUP BY 1, 2) WHERE n > 1 UNION ALL
      SELECT product_id, 'content', n FROM (SELECT product_id, content, count(*) AS n FROM reviews GROUP BY 1, 2) WHERE n > 1""",
    "base_parity": f"""{PLAIN}, a AS (SELECT review_id, author, rating FROM reviews), b AS (SELECT review_id, author, CASE WHEN review_id % 100 = 0 THEN rating + 1 ELSE rating END AS rating FROM a WHERE review_id % 101 <> 1)
      SELECT *, 'left' AS side FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b) UNION ALL SELECT *, 'right' FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a)""",
    "vector_contract": "SELECT vec_id, CASE WHEN vec_id % 50 = 7 THEN 'wrong_dimension' ELSE 'missing' END AS violation FROM embeddings WHERE vec_id % 50 IN (7, 9)",
    "golden_trace": f"{ALL}, {TRACE} SELECT * FROM traced",
    "golden_recall": f"{ALL}, {TRACE} SELECT count(*) AS targets, count(*) FILTER (outcome <> 'untraceable') AS traceable, count(*) FILTER (outcome = 'produced') AS produced, round(count(*) FILTER (outcome = 'produced') / nullif(count(*) FILTER (outcome <> 'untraceable'), 0), 4) AS recall, count(*) FILTER (direction_match = false) AS direction_mismatches FROM traced",
    "claim_confidence": f"{ALL}, {CONFIDENCE} SELECT * FROM banded",
    "claim_summary": f"{ALL}, {CONFIDENCE} SELECT claim_type, band, count(*) AS claims, count(*) FILTER (exposable) AS exposable FROM banded GROUP BY 1, 2",
    "run_report": f"{ALL} SELECT direction, axis, count(*) AS claims, CAST(sum(support) AS BIGINT) AS authors FROM judged WHERE reason IS NULL GROUP BY 1, 2",
    "ingest_profile": f"""{PLAIN}, per AS (SELECT product_id, count(*) AS n FROM reviews GROUP BY 1), copies AS (SELECT content, count(*) AS n FROM reviews GROUP BY 1 HAVING count(*) > 1),
      cells AS (SELECT product_id, coalesce(skin_type, '미기재') AS s, count(*) AS n, count(DISTINCT author) AS a FROM reviews GROUP BY 1, 2)
      SELECT count(*) AS reviews, round(100 * avg(CASE WHEN skin_type IS NOT NULL THEN 1 ELSE 0 END), 1) AS skin_stated, round(100 * avg(CASE WHEN len(troubles) > 0 THEN 1 ELSE 0 END), 1) AS trouble_stated,
        round(100 * avg(CASE WHEN option IS NOT NULL THEN 1 ELSE 0 END), 1) AS option_stated, (SELECT count(*) FROM per) AS products, (SELECT min(n) FROM per) AS reviews_min, (SELECT max(n) FROM per) AS reviews_max,
        (SELECT list_sort(list(n))[len(list(n)) // 2 + 1] FROM per) AS reviews_median, (SELECT count(*) FROM (SELECT DISTINCT author, product_id FROM reviews)) AS author_products,
        (SELECT count(*) FROM copies) AS copy_groups, (SELECT CAST(coalesce(sum(n), 0) AS BIGINT) FROM copies) AS copied_reviews, (SELECT count(*) FROM cells) AS skin_cells, (SELECT count(*) FROM cells WHERE n >= 8) AS skin_cells_8_reviews,
        (SELECT count(*) FROM cells WHERE a >= 8) AS skin_cells_8_authors, (SELECT count(DISTINCT t) FROM (SELECT unnest(troubles) AS t FROM reviews)) AS trouble_segments,
        count(*) - (SELECT count(*) FROM (SELECT DISTINCT author, product_id FROM reviews)) AS excess_votes FROM reviews""",
    "trust_profile": f"""{RANKED}, s AS (SELECT list_sort(list(trust_score)) AS s, count(*) AS n FROM ranked)
      SELECT s[1] AS min, s[least(n - 1, CAST(floor(n * 0.25) AS BIGINT)) + 1] AS p25, s[least(n - 1, CAST(floor(n * 0.5) AS BIGINT)) + 1] AS p50, s[least(n - 1, CAST(floor(n * 0.75) AS BIGINT)) + 1] AS p75,
        s[least(n - 1, CAST(floor(n * 0.95) AS BIGINT)) + 1] AS p95, s[n] AS max, CAST(len(list_distinct(s)) AS BIGINT) AS scores FROM s""",
    "pass_union": f"{PLAIN} SELECT review_id, CASE WHEN rating >= 4 THEN 0 WHEN rating <= 2 THEN 1 ELSE 2 END AS pass FROM reviews",
    "resume_products": f"{PLAIN} SELECT product_id, count(*) AS reviews FROM reviews GROUP BY 1 HAVING count(*) >= 1450",
    "sku_stats": "SELECT l_suppkey AS requested_goods, count(DISTINCT l_partkey) AS goods, count(*) AS rows FROM lineitem GROUP BY 1",
    "crawl_outcomes": f"{PLAIN} SELECT CASE WHEN n >= 1450 THEN 'full' ELSE 'partial' END AS outcome, count(*) AS products, CAST(sum(n) AS BIGINT) AS reviews FROM (SELECT product_id, count(*) AS n FROM reviews GROUP BY 1) GROUP BY 1",
    "run_catalog": "SELECT 'p001' AS product_id, 'A' || lpad(CAST(l_suppkey AS VARCHAR), 12, '0') AS goods_no, count(*) AS rows, 'unobserved' AS renewal_policy FROM lineitem GROUP BY l_suppkey",
    "goods_in_urls": r"""WITH u AS (SELECT page_id, url || CASE WHEN page_id % 3 > 0 THEN '&goodsNo=A' || lpad(CAST(page_id AS VARCHAR), 12, '0') ELSE '' END || CASE WHEN page_id % 3 = 2 THEN '/A000000000001' ELSE '' END AS url FROM pages),
      f AS (SELECT page_id, list_distinct(regexp_extract_all(url, '\bA[0-9]{12}\b')) AS ids FROM u) SELECT page_id, CAST(len(ids) AS INTEGER) AS found, CASE WHEN len(ids) = 1 THEN ids[1] END AS goods_no FROM f""",
    "model_json": "SELECT conv_id, turn, conv_id AS parsed_id, turn AS parsed_turn FROM conversations",
    "condition_questions": f"""{MEMBER} SELECT product_id, segment, coalesce(CASE segment WHEN 'FURNITURE' THEN '건성 피부' WHEN 'AUTOMOBILE' THEN '지성 피부' WHEN 'MACHINERY' THEN '복합성 피부' WHEN 'HOUSEHOLD' THEN '민감성 피부' END, '조건을 밝히지 않은 사용자') AS label, cell_authors
      FROM sizes WHERE axis = 'skinType'""",
    "tag_batches": f"{PLAIN} SELECT review_id // 20 AS batch, count(*) AS reviews, min(review_id) AS first_id FROM reviews GROUP BY 1",
    "untagged_reviews": f"{PLAIN} SELECT review_id, product_id FROM reviews WHERE review_id NOT IN (SELECT review_id FROM tags)",
    "table_digest": f"""{PLAIN}, h AS (SELECT product_id, review_id, sha256(concat_ws('␟', review_id, content, rating)) AS h FROM reviews),
      part AS (SELECT product_id, review_id // 1000 AS part, sha256(string_agg(h, chr(10) ORDER BY review_id)) AS h FROM h GROUP BY 1, 2)
      SELECT product_id, sha256(string_agg(h, chr(10) ORDER BY part)) AS digest FROM part GROUP BY 1""",
}

LINES = r"""
product_lines AS (
  SELECT b.*, 'L' || CAST(s_suppkey // 3 AS VARCHAR) AS lineage_id, CASE WHEN s_suppkey % 5 = 0 THEN 'single' ELSE 'separate' END AS renewal_policy,
    CASE WHEN s_suppkey % 3 = 2 THEN 'A' || CAST(s_suppkey AS VARCHAR) END AS requested_goods_no FROM bridge b JOIN supplier ON product_id = 'p' || CAST(s_suppkey AS VARCHAR)
)
"""

LABELS = r"""
cited0 AS (
  SELECT author AS label_id, review_id, CASE WHEN review_id % 19 = 0 THEN 'unsure' WHEN rating <= 2 THEN 'negative' WHEN rating >= 4 THEN 'positive' ELSE 'neutral' END AS stance,
    CASE WHEN review_id % 23 = 0 THEN 'not said' WHEN review_id % 29 = 0 THEN ' ' ELSE substr(content, 1, 5) END AS quote, product_id AS of_review, content FROM reviews
), cited AS (SELECT * FROM cited0 UNION ALL SELECT * FROM cited0 WHERE review_id % 31 = 0),
labels AS (
  SELECT author AS label_id, min(product_id) AS product_id, CASE author % 4 WHEN 0 THEN 'unheard of' WHEN 1 THEN '보습감' END AS aspect, CASE WHEN author % 2 = 0 THEN 'mixed' ELSE 'positive' END AS direction,
    author % 5 AS minutes FROM reviews GROUP BY author
), support AS (
  SELECT label_id, count(DISTINCT CASE WHEN stance = 'positive' THEN label_id END) AS pos, count(DISTINCT CASE WHEN stance = 'negative' THEN label_id END) AS neg,
    count(DISTINCT CASE WHEN stance = 'neutral' THEN label_id END) AS neu, count(DISTINCT label_id) AS spoke, count(*) AS evidence FROM cited GROUP BY 1
), told AS (SELECT *, CASE WHEN pos > 0 AND neg > 0 THEN 'mixed' WHEN pos > 0 THEN 'positive' WHEN neg > 0 THEN 'negative' ELSE 'neutral' END AS derived FROM support)
"""

SUBJECT = """CASE WHEN axis = 'product' THEN '조건 없음 (이 제품 리뷰 전체)' WHEN segment = '미기재' THEN CASE axis WHEN 'skinType' THEN '피부타입을 안 밝힌 리뷰' ELSE '피부고민을 안 밝힌 리뷰' END
      ELSE CASE segment WHEN 'FURNITURE' THEN '건성' WHEN 'AUTOMOBILE' THEN '지성' WHEN 'MACHINERY' THEN '복합성' WHEN 'C01' THEN '잡티' WHEN 'C02' THEN '주름' ELSE segment END || CASE axis WHEN 'skinType' THEN ' 피부' ELSE ' 고민' END END"""

SCOPE = r"""
top AS (
  SELECT product_id, max({'n': n, 'k': shade_key}).k AS want FROM (SELECT product_id, shade_key, sum(reviews) AS n FROM options WHERE shade_key IS NOT NULL GROUP BY 1, 2) GROUP BY 1
)
"""

QUERIES |= {
    "lineages": f"""WITH {BRIDGE}, {LINES}, g AS (SELECT *, requested_goods_no IS NOT NULL AS current, count(requested_goods_no) OVER (PARTITION BY lineage_id) AS on_sale FROM product_lines)
      SELECT lineage_id, product_id, CAST(row_number() OVER (PARTITION BY lineage_id ORDER BY coalesce(from_month, ''), product_id) AS INTEGER) AS generation, current, NOT current AND on_sale = 1 AS previous FROM g""",
    "catalog_contract": f"""WITH {BRIDGE}, {LINES}, shared AS (SELECT goods_no, count(*) AS n, count(*) FILTER (from_month IS NULL AND to_month IS NULL) AS open FROM product_lines GROUP BY 1)
      SELECT lineage_id AS subject, 'generations_not_separate' AS violation FROM product_lines GROUP BY 1 HAVING count(*) > 1 AND count(*) FILTER (renewal_policy <> 'separate') > 0 UNION ALL
      SELECT lineage_id, 'not_one_on_sale' FROM product_lines GROUP BY 1 HAVING count(requested_goods_no) <> 1 UNION ALL
      SELECT goods_no, 'shared_across_lineages' FROM product_lines GROUP BY 1 HAVING count(DISTINCT lineage_id) > 1 UNION ALL
      SELECT goods_no, 'shared_with_open_range' FROM shared WHERE n > 1 AND open > 0 UNION ALL
      SELECT DISTINCT a.goods_no, 'overlapping_ranges' FROM bridge a JOIN bridge b ON a.goods_no = b.goods_no AND a.product_id < b.product_id
      WHERE coalesce(a.from_month, '0000') <= coalesce(b.to_month, '9999') AND coalesce(b.from_month, '0000') <= coalesce(a.to_month, '9999')""",
    "condition_subjects": f"""{MEMBER} SELECT product_id, axis, segment, {SUBJECT} AS subject, cell_authors FROM sizes""",
    "cell_matches": f"{PLAIN} SELECT review_id, product_id, array_to_string(troubles, ',') AS troubles FROM reviews WHERE skin_type IS NULL AND list_contains(troubles, 'C01') AND list_contains(troubles, 'C02')",
    "option_scope": f"""WITH {BASE}, {IDENTITY}, {OPTIONS}, {SCOPE} SELECT i.review_id, i.product_id, o.kind,
      coalesce(i.reason, CASE WHEN o.kind IS NULL THEN 'option_unstated' WHEN o.shade_key IS DISTINCT FROM t.want OR t.want IS NULL THEN 'option_mismatch' END, 'passed') AS reason
      FROM identity i LEFT JOIN options o ON o.product_id = i.product_id AND o.option = i.option LEFT JOIN top t ON t.product_id = i.product_id""",
    "evidence_fates": f"""{ALL}, cited AS (SELECT o_orderkey AS key, o_orderkey AS review_id FROM orders UNION ALL SELECT o_orderkey, o_orderkey * 2 FROM orders)
      SELECT c.key, c.review_id, CASE WHEN i.review_id IS NULL THEN 'unknown' WHEN i.reason IS NOT NULL THEN 'identity/' || i.reason WHEN d.reason IS NOT NULL THEN 'duplicate/' || d.reason ELSE 'kept' END AS fate
      FROM cited c LEFT JOIN identity i USING (review_id) LEFT JOIN duplicate d USING (review_id)""",
    "claim_contract": f"""{MEMBER}, c AS (SELECT *, pos + neu AS k, product_id || '|' || axis || '=' || segment || '|' || aspect AS claim_id, CASE WHEN pos > 0 AND neg > 0 THEN 'mixed' WHEN pos > 0 THEN 'positive' WHEN neg > 0 THEN 'negative' ELSE 'neutral' END AS told FROM claims)
      SELECT claim_id, 'blank_aspect' AS violation FROM c WHERE k % 13 = 0 UNION ALL SELECT claim_id, 'spoke_is_not_the_sum' FROM c WHERE pos + neg + neu <> spoke UNION ALL
      SELECT claim_id, 'negative_count' FROM c WHERE cell_authors < spoke UNION ALL
      SELECT claim_id, 'support_beyond_spoke' FROM c WHERE pos + neg + CASE WHEN k % 5 = 0 THEN 100000 ELSE 0 END > spoke UNION ALL SELECT claim_id, 'no_evidence' FROM c WHERE k % 3 <> 0 AND k % 17 = 0 UNION ALL
      SELECT claim_id, 'evidence_twice' FROM c WHERE k % 3 = 0 UNION ALL SELECT claim_id, 'direction_not_derived' FROM c WHERE k % 7 = 0 AND told <> 'positive' UNION ALL
      SELECT claim_id, 'unknown_type' FROM c WHERE axis <> 'product' AND k % 11 = 0""",
    "golden_support": f"{PLAIN}, {LABELS} SELECT label_id, pos, neg, neu, spoke, evidence, derived AS direction FROM told",
    "golden_contract": f"""{PLAIN}, {LABELS}
      SELECT DISTINCT label_id, 'review_outside_bundle' AS violation FROM cited JOIN labels USING (label_id) WHERE of_review <> product_id UNION ALL
      SELECT DISTINCT label_id, 'unknown_stance' FROM cited WHERE stance = 'unsure' UNION ALL SELECT DISTINCT label_id, 'blank_quote' FROM cited WHERE trim(quote) = '' UNION ALL
      SELECT DISTINCT label_id, 'not_verbatim' FROM cited WHERE NOT contains(content, quote) UNION ALL
      SELECT DISTINCT label_id, 'evidence_twice' FROM (SELECT label_id, review_id FROM cited GROUP BY 1, 2 HAVING count(*) > 1) UNION ALL
      SELECT label_id, 'unknown_aspect' FROM labels WHERE aspect = 'unheard of' UNION ALL SELECT label_id, 'direction_not_derived' FROM labels JOIN told USING (label_id) WHERE derived <> direction UNION ALL
      SELECT label_id, 'minutes_not_positive' FROM labels WHERE minutes <= 0""",
    "snapshot_guard": f"{PLAIN} SELECT max(month) AS latest_month, max(month) <= '2000-12' AS current FROM reviews",
    "layout_text": f"""{RANKED_MEMBER}, {QUOTES}, {KEPT}, shown AS (
        SELECT product_id, axis, segment, aspect, count(*) AS n, string_agg('  ' || quote_rank || '. [' || polarity || '] ' || review_id || CASE WHEN reserved THEN ' *' ELSE '' END, chr(10) ORDER BY quote_rank) AS q
        FROM keeping GROUP BY 1, 2, 3, 4),
      c AS (SELECT *, pos + neg AS support, cell_authors - spoke AS silent FROM claims)
      SELECT product_id, axis, segment, aspect, '[1] ' || product_id || ' ' || aspect || chr(10) || '[2] ' || {SUBJECT} || chr(10) || '[3] ' || n || chr(10) || q || chr(10) ||
        '[4] ' || CASE WHEN pos > 0 AND neg > 0 THEN 'mixed' WHEN pos > 0 THEN 'positive' WHEN neg > 0 THEN 'negative' ELSE 'neutral' END || ' +' || pos || ' -' || neg || ' / ' || spoke || chr(10) ||
        '[5] U=' || support || ' D=' || spoke || ' S=' || cell_authors || ' (' || silent || ') ' ||
        CASE WHEN support > spoke OR spoke > cell_authors THEN 'invariant_broken' WHEN cell_authors < 8 THEN 'segment_too_small' WHEN support < 8 THEN 'insufficient_support' WHEN support / spoke < 0.10 THEN 'minority_share' ELSE 'passed' END AS layout
      FROM c JOIN shown USING (product_id, axis, segment, aspect)""",
    "api_reviews": f"""{PLAIN} SELECT review_id AS "reviewId", CASE WHEN review_id % 7 = 1 THEN '' ELSE content END AS content, rating, likes / 4 AS "usefulPoint", CAST(likes AS INTEGER) AS "recommendCount", review_date AS "reviewDate",
      review_id % 7 = 3 AS "hasPhoto", false AS "isRepurchase", 'A000000000001' AS "goodsNo", trim(coalesce(option, '')) AS option, CASE WHEN review_id % 7 = 4 THEN '' ELSE CAST(author AS VARCHAR) END AS "userName",
      CASE WHEN review_id % 7 = 4 THEN '' ELSE coalesce(skin_type, '') END AS "skinType", CASE WHEN review_id % 7 IN (4, 5) THEN '' ELSE array_to_string(troubles, ',') END AS "skinTrouble" FROM reviews""",
}
