"""DuckDB SQL of the queries of contracts, claim rows and orders."""

from __future__ import annotations

from ..operators.records import KNOWN_FIELDS
from ..schemas import FAILURES, SEVERITIES
from .oracles import ALL, BASE, CELLS, CONFLICTS, IDENTITY, KEPT, MEMBER, OPTIONS, PLAIN, QUOTES, RANKED_MEMBER, SCORED, SPLITS, TRACE, _binom, quote_walk

_KNOWN = "[" + ", ".join(f"'{n}'" for n in KNOWN_FIELDS) + "]"
_WORST_FIRST = "[" + ", ".join(f"'{k}'" for k, _, _ in sorted(FAILURES, key=lambda t: (SEVERITIES.index(t[1]), t[2]))) + "]"
_SOME = ", ".join(f"CASE WHEN (turn + conv_id) % {i + 2} = 0 THEN '{k}' END" for i, (k, _, _) in enumerate(FAILURES))
_CANDIDATE = "product_id || '|' || axis || '=' || segment || '|' || aspect"

# The gates run again for every scope that a label asks for: identity with the option, the walk in rank order, cells, counts.
SCOPED = f"""
WITH RECURSIVE {BASE}, {IDENTITY}, passed AS (SELECT * EXCLUDE (reason, renewal_policy, from_month, to_month) FROM identity WHERE reason IS NULL), {SCORED.replace('{source}', 'passed')},
bought AS (SELECT review_id, CASE WHEN review_id % 7 = 0 OR review_id % 11 = 0 THEN NULL ELSE (review_id // 10) % 3 + 1 END AS shade, review_id % 7 = 0 AS unstated FROM reviews),
labels AS (
  SELECT r.review_id AS key, product_id, 'skinType' AS axis, coalesce(skin_type, 'none') AS segment, coalesce(t.aspect, 'nothing') AS aspect, CASE WHEN rating <= 2 THEN 'negative' WHEN rating >= 4 THEN 'positive' ELSE 'neutral' END AS want,
    CASE WHEN r.review_id % 5 = 0 THEN 0 WHEN r.review_id % 23 = 0 OR r.review_id % 29 = 0 THEN -1 ELSE r.review_id % 3 + 1 END AS asks
  FROM reviews r LEFT JOIN (SELECT review_id, min(aspect) AS aspect FROM tags GROUP BY 1) t USING (review_id)
), shades AS (SELECT DISTINCT product_id, shade FROM reviews JOIN bought USING (review_id) WHERE shade IS NOT NULL),
resolved AS (SELECT l.*, CASE WHEN asks = 0 THEN 0 WHEN s.shade IS NOT NULL THEN asks END AS scope FROM labels l LEFT JOIN shades s ON s.product_id = l.product_id AND s.shade = l.asks),
runs AS (SELECT DISTINCT product_id AS p, scope FROM resolved WHERE scope IS NOT NULL),
gate1 AS (
  SELECT u.scope, i.*, CASE WHEN i.reason IS NOT NULL THEN i.reason WHEN u.scope > 0 AND b.unstated THEN 'option_unstated' WHEN u.scope > 0 AND b.shade IS DISTINCT FROM u.scope THEN 'option_mismatch' END AS stop
  FROM runs u JOIN identity i ON i.product_id = u.p JOIN bought b USING (review_id)
), inside AS (SELECT r.* REPLACE (r.product_id || '~' || g.scope AS product_id, row_number() OVER (PARTITION BY r.product_id, g.scope ORDER BY r.rank) AS rank) FROM gate1 g JOIN ranked r USING (review_id) WHERE g.stop IS NULL),
scope_walk AS (
  SELECT product_id, CAST(0 AS BIGINT) AS rank, CAST(NULL AS VARCHAR) AS reason, CAST([] AS VARCHAR[]) AS contents, CAST([] AS BIGINT[]) AS authors FROM (SELECT DISTINCT product_id FROM inside)
  UNION ALL
  SELECT r.product_id, r.rank, CASE WHEN list_contains(w.contents, r.content_hash) THEN 'duplicate_content' WHEN list_contains(w.authors, r.author) THEN 'same_author' END,
    CASE WHEN list_contains(w.contents, r.content_hash) OR list_contains(w.authors, r.author) THEN w.contents ELSE list_append(w.contents, r.content_hash) END,
    CASE WHEN list_contains(w.contents, r.content_hash) OR list_contains(w.authors, r.author) THEN w.authors ELSE list_append(w.authors, r.author) END
  FROM scope_walk w JOIN inside r ON r.product_id = w.product_id AND r.rank = w.rank + 1
), gate2 AS (SELECT r.*, w.reason FROM scope_walk w JOIN inside r USING (product_id, rank)),
survivors AS (SELECT * EXCLUDE (reason) FROM gate2 WHERE reason IS NULL), {CELLS.replace('{source}', 'survivors')},
scope_judged AS (
  SELECT *, CASE WHEN pos > 0 AND neg > 0 THEN 'mixed' WHEN pos > 0 THEN 'positive' WHEN neg > 0 THEN 'negative' ELSE 'neutral' END AS direction,
    CASE WHEN cell_authors < 8 THEN 'segment_too_small' WHEN pos + neg < 8 THEN 'insufficient_support' WHEN (pos + neg) / spoke < 0.10 THEN 'minority_share' END AS reason FROM claims
), scope_said AS (
  SELECT m.product_id, m.axis, m.segment, t.aspect, count(*) FILTER (polarity = 'positive') AS p, count(*) FILTER (polarity = 'negative') AS n FROM member m JOIN tags t USING (review_id) GROUP BY ALL
), scope_limits AS (
  SELECT *, CASE WHEN p > 0 AND n > 0 AND {_binom('least(p, n)', '(p + n)', '0.033')} >= 0.05 THEN 'minority_within_tagger_noise' END AS l1, CASE WHEN p + n > 0 THEN 'tagger_direction_error' END AS l2 FROM scope_said
), open_renewal AS (SELECT DISTINCT product_id || '~' || scope AS product_id FROM gate1 WHERE stop IS NULL AND renewal_policy = 'unobserved')
"""

QUERIES = {
    "closed_fields": f"""WITH r AS (SELECT o_orderkey AS review_id, o_orderkey % 11 AS k FROM orders),
      f AS (SELECT review_id, k, list_concat(list_filter({_KNOWN}, lambda n: n <> 'hasPhoto' OR k <> 3), CASE WHEN k = 5 THEN ['rank', 'shade'] ELSE [] END) AS names FROM r WHERE k <> 7)
      SELECT review_id, 'unknown_field' AS violation, unnest(list_filter(names, lambda n: NOT list_contains({_KNOWN}, n))) AS field FROM f UNION ALL
      SELECT review_id, 'missing_field', unnest(list_filter({_KNOWN}, lambda n: NOT list_contains(names, n))) FROM f UNION ALL SELECT review_id, 'not_an_object', NULL FROM r WHERE k = 7""",
    "array_reviews": f"""{PLAIN} SELECT review_id AS "reviewId", content || ' }}{{"a": [\\"]}}' AS content, rating, review_date AS "reviewDate", CAST(author AS VARCHAR) AS "userName", option, skin_type AS "skinType",
      array_to_string(troubles, ',') AS troubles, CAST(likes AS INTEGER) AS "recommendCount" FROM reviews""",
    "file_codebook": f"""{PLAIN}, used AS (SELECT 'skinTrouble' AS axis, unnest(troubles) AS code FROM reviews UNION ALL SELECT 'skinType', 'A' || lpad(CAST(c_nationkey AS VARCHAR), 2, '0') FROM customer UNION ALL
      SELECT 'skinTone', 'B' || lpad(CAST(n_regionkey AS VARCHAR), 2, '0') FROM nation), n AS (SELECT axis, code, count(*) AS uses FROM used GROUP BY ALL),
      book AS (SELECT 'skinType' AS axis, 'A' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS code, n_name AS label FROM nation UNION ALL SELECT 'skinTone', 'B' || lpad(CAST(r_regionkey AS VARCHAR), 2, '0'), r_name FROM region UNION ALL
      SELECT DISTINCT 'skinTrouble', 'C0' || substr(p_brand, 7, 1), 'brand ' || substr(p_brand, 7, 1) FROM part)
      SELECT axis, code, label, coalesce(uses, 0) AS uses FROM book LEFT JOIN n USING (axis, code)""",
    "review_records": f"""{PLAIN}, c AS (SELECT *, CASE WHEN review_id % 5 <> 0 THEN skin_type END AS t, list_sort(list_distinct(CASE WHEN review_id % 5 = 1 THEN list_append(troubles, 'C03') ELSE troubles END)) AS codes FROM reviews)
      SELECT review_id, product_id, content, rating, review_id % 5 = 2 AS "hasPhoto", t AS "skinType_code", t IS NOT NULL AS "skinType_stated", coalesce(t, '미기재') AS "skinType_segment", option AS option_code,
        option IS NOT NULL AS option_stated, coalesce(option, '미기재') AS option_segment, array_to_string(codes, ',') AS "skinTrouble_codes", CASE WHEN len(codes) > 0 THEN array_to_string(codes, ',') ELSE '미기재' END AS "skinTrouble_segments",
        len(codes) > 0 AS "skinTrouble_stated", CAST(author AS VARCHAR) AS "authorKey", substr(sha256(content), 1, 16) AS "contentHash", CAST(length(content) AS INTEGER) AS "contentLength",
        CASE WHEN rating <= 2 THEN 'negative' WHEN rating >= 4 THEN 'positive' ELSE 'neutral' END AS "sentimentPrior", month AS "reviewYearMonth" FROM c""",
    "condition_codes": f"""{PLAIN}, used AS (SELECT 'skinTrouble' AS axis, unnest(troubles) AS code FROM reviews UNION ALL SELECT 'skinType', skin_type FROM reviews WHERE skin_type IS NOT NULL UNION ALL
        SELECT 'skinTrouble', 'A0' || (review_id % 4) FROM reviews)
      SELECT axis, code, count(*) AS uses, CASE WHEN NOT regexp_matches(code, '^[A-Z][0-9][0-9]$') THEN 'not_a_code' WHEN NOT starts_with(code, CASE axis WHEN 'skinTrouble' THEN 'C' ELSE 'A' END) THEN 'other_axis' ELSE 'out_of_domain' END AS hint
      FROM used WHERE (axis, code) NOT IN (('skinTrouble', 'C01'), ('skinTrouble', 'C02'), ('skinType', 'A01')) GROUP BY 1, 2""",
    "photo_trust": f"""{PLAIN}, s AS (SELECT review_id, round(least(1.0, greatest(0.0, (length(content) - 22) / 456.0)), 6) AS l, round(1.0 / count(*) OVER (PARTITION BY content), 6) AS u,
        round(percent_rank() OVER (PARTITION BY product_id ORDER BY likes), 6) AS p, CASE WHEN review_id % 3 = 0 THEN 1.0 ELSE 0.0 END AS s_photo, CASE WHEN review_id % 4 = 1 THEN 1.0 ELSE 0.0 END AS s_usage FROM reviews)
      SELECT review_id, CAST(s_photo AS DOUBLE) AS s_photo, CAST(s_usage AS DOUBLE) AS s_usage, round((l * 0.6 + u * 0.4 + p * 0.1 + s_photo * 0.2 + s_usage * 0.3) / (0.6 + 0.4 + 0.1 + 0.2 + 0.3), 4) AS trust_score, 'onTopic' AS unavailable FROM s""",
    "dedup_keys": """SELECT o_orderkey AS review_id, 'no_author' AS violation FROM orders WHERE o_orderkey % 13 IN (1, 2) UNION ALL SELECT o_orderkey, 'no_content_hash' FROM orders WHERE o_orderkey % 13 = 2 UNION ALL
      SELECT o_orderkey, 'no_trust_score' FROM orders WHERE o_orderkey % 13 IN (3, 4)""",
    "reject_registry": """SELECT CASE o_orderkey % 8 WHEN 1 THEN 'polarity' WHEN 2 THEN 'taste' WHEN 3 THEN 'duplicate' WHEN 4 THEN 'duplicate' WHEN 6 THEN 'sufficiency' END AS gate,
      CASE o_orderkey % 8 WHEN 4 THEN 'duplicate_semantic' WHEN 6 THEN 'typo' ELSE 'recency_cut' END AS reason, CAST(o_orderkey AS VARCHAR) AS subject,
      CASE o_orderkey % 8 WHEN 1 THEN 'gate_rejects_nothing' WHEN 3 THEN 'wrong_gate' WHEN 4 THEN 'reserved_reason' WHEN 6 THEN 'unknown_reason' ELSE 'unknown_gate' END AS violation FROM orders WHERE o_orderkey % 8 NOT IN (0, 5)""",
    "stance_overlaps": f"{MEMBER} SELECT product_id, axis, segment, aspect, author, CAST(count(DISTINCT polarity) AS INTEGER) AS stances FROM member JOIN tags USING (review_id) GROUP BY 1, 2, 3, 4, 5 HAVING count(DISTINCT polarity) > 1",
    "outside_authors": f"""{MEMBER} SELECT product_id, axis, segment, author FROM member JOIN tags USING (review_id) EXCEPT SELECT product_id, axis, segment, author FROM member WHERE review_id % 7 <> 0""",
    "silent_cells": f"{ALL} SELECT product_id, axis, segment, cell_authors FROM sizes WHERE cell_authors < 8",
    "shade_axes": f"{PLAIN}, {OPTIONS} SELECT product_id, count(DISTINCT shade_key) AS shades FROM options WHERE shade_key IS NOT NULL GROUP BY 1 HAVING count(DISTINCT shade_key) >= 2",
    "option_scopes": f"""{PLAIN}, {OPTIONS}, asked AS (SELECT DISTINCT CASE WHEN review_id % 3 = 0 THEN 'p' || lpad(CAST((review_id + 1) % 10 AS VARCHAR), 3, '0') ELSE product_id END AS product_id, option FROM reviews WHERE option IS NOT NULL)
      SELECT a.product_id, a.option, o.shade_key, CASE WHEN o.kind IS NULL THEN 'unknown_option' WHEN o.kind <> 'shade' THEN 'pack_option' END AS violation FROM asked a LEFT JOIN options o ON o.product_id = a.product_id AND o.option = a.option""",
    "claim_targets": f"{ALL} SELECT claim_id, product_id, axis, segment, aspect, review_id FROM judged JOIN member USING (product_id, axis, segment) WHERE reason IS NULL",
    "target_slice": f"{ALL} SELECT claim_id, product_id, aspect FROM judged WHERE reason IS NULL ORDER BY claim_id LIMIT 100",
    "gate_parity": f"""{MEMBER}, n AS (SELECT product_id, axis, segment, count(*) AS n FROM member GROUP BY 1, 2, 3),
      s AS (SELECT product_id, axis, segment, aspect, count(*) FILTER (polarity = 'positive') AS p, count(*) FILTER (polarity = 'negative') AS g, count(*) FILTER (polarity = 'neutral') AS u FROM member JOIN tags USING (review_id) GROUP BY 1, 2, 3, 4),
      j AS (SELECT * FROM s JOIN n USING (product_id, axis, segment) JOIN claims USING (product_id, axis, segment, aspect))
      SELECT product_id, axis, segment, aspect, 'pos' AS count FROM j WHERE p <> pos UNION ALL SELECT product_id, axis, segment, aspect, 'neg' FROM j WHERE g <> neg UNION ALL
      SELECT product_id, axis, segment, aspect, 'neu' FROM j WHERE u <> neu UNION ALL SELECT product_id, axis, segment, aspect, 'silent' FROM j WHERE n - p - g - u <> cell_authors - spoke""",
    "label_conditions": f"""{PLAIN} SELECT author AS label_id, review_id, 'skinType' AS axis, CASE author % 4 WHEN 0 THEN 'FURNITURE' ELSE '미기재' END AS segment FROM reviews
        WHERE author % 4 < 2 AND coalesce(skin_type, '미기재') <> CASE author % 4 WHEN 0 THEN 'FURNITURE' ELSE '미기재' END UNION ALL
      SELECT author, review_id, 'skinTrouble', c FROM reviews, (SELECT unnest(['C01', 'C02']) AS c) WHERE author % 4 >= 1 AND NOT list_contains(troubles, c)""",
    "draft_contract": f"""{MEMBER}, d AS (SELECT {_CANDIDATE} AS claim_id, axis, segment, (pos + neg + neu) % 7 AS k FROM claims)
      SELECT claim_id, 'no_evidence' AS violation, CAST(NULL AS VARCHAR) AS field FROM d WHERE k = 1 UNION ALL SELECT claim_id, 'unknown_evidence_field', 'page' FROM d WHERE k = 2 UNION ALL
      SELECT claim_id, 'missing_condition', NULL FROM d WHERE k = 4 AND (axis = 'product' OR segment = '미기재') UNION ALL
      SELECT claim_id, 'code_field', 'support' FROM d WHERE k = 5 UNION ALL SELECT claim_id, 'missing_field', 'verdict' FROM d WHERE k = 6""",
    "claim_rows": f"""{ALL} SELECT 'claim-v1' AS schema_version, claim_id, product_id, aspect || '?' AS question, CASE WHEN axis = 'skinType' THEN segment END AS "skinType", CASE WHEN axis = 'skinTrouble' THEN segment END AS "skinTrouble",
      CASE WHEN axis = 'product' THEN 'unconditional' ELSE 'conditional' END AS claim_type, direction, pos AS "positiveAuthors", neg AS "negativeAuthors", neu AS "neutralAuthors", spoke AS "spokeAuthors", silent AS "silentAuthors",
      support AS "supportAuthors", cell_authors AS "cellAuthors", coalesce(limitation, '') AS limitations, CAST(NULL AS VARCHAR) AS failure_reason FROM judged WHERE reason IS NULL""",
    "claim_round_trip": """WITH r AS (SELECT CAST(o_orderkey AS VARCHAR) AS claim_id, o_orderkey % 9 AS k FROM orders)
      SELECT claim_id, 'failures_unsorted' AS violation FROM r WHERE k = 0 UNION ALL SELECT claim_id, 'failure_not_first' FROM r WHERE k IN (0, 2, 6) UNION ALL SELECT claim_id, 'unknown_failure' FROM r WHERE k = 2 UNION ALL
      SELECT claim_id, 'type_not_derived' FROM r WHERE k IN (3, 7) UNION ALL SELECT claim_id, 'unstated_with_codes' FROM r WHERE k = 4 UNION ALL SELECT claim_id, 'schema_version' FROM r WHERE k = 5""",
    "failure_order": f"""WITH f AS (SELECT conv_id, turn, list_filter({_WORST_FIRST}, lambda k: list_contains(list_filter([{_SOME}], lambda x: x IS NOT NULL), k)) AS found FROM conversations)
      SELECT conv_id, turn, array_to_string(found, ',') AS failures, found[1] AS failure FROM f""",
    "condition_assertions": """SELECT conv_id, turn, regexp_matches(text || CASE conv_id % 4 WHEN 0 THEN ' 건성 인데' WHEN 1 THEN ' 모공이라' WHEN 2 THEN ' 트러블 피부라서' ELSE ' 주름' END,
      '(건성|지성|복합성|민감성|약건성|중성|트러블성|트러블 피부|여드름성|잡티|모공|주름|각질|블랙헤드|미백)\\s*(인데|이라|이라서|라서|인 사람|이신 분)') AS asserts FROM conversations""",
    "gated_payloads": f"""WITH RECURSIVE quoted AS (
        SELECT doc_id // 6 AS claim_id, CAST(doc_id % 6 AS INTEGER) AS position, doc_id AS quote_id, CASE WHEN doc_id % 6 >= 3 AND (doc_id + doc_id // 6) % 4 = 0 THEN doc_id // 6 * 6 + 1 ELSE doc_id END AS review_id,
          CASE WHEN (doc_id * 7 + doc_id // 6) % 5 < 2 OR (doc_id // 6) % 17 = 0 THEN 'fabricated' ELSE 'verbatim' END AS status, doc_id % 6 >= 3 AS spare FROM documents), {quote_walk(2)}
      SELECT claim_id, outcome, CASE WHEN outcome <> 'discarded' THEN 'answer ' || claim_id END AS answer, CASE WHEN outcome <> 'discarded' THEN ids END AS evidence
      FROM outcomes LEFT JOIN (SELECT claim_id, string_agg(quote_id || ':' || review_id, ',' ORDER BY kept_order) AS ids FROM walked WHERE kept_order IS NOT NULL GROUP BY 1) USING (claim_id)""",
    "scoped_trace": f"""{SCOPED}
      SELECT key, outcome, gate, reason, direction, direction_match, CASE WHEN outcome = 'untraceable' OR reason IS NOT DISTINCT FROM 'empty_cell' THEN '' ELSE array_to_string(list_sort(list_filter([r, l1, l2, d1], lambda x: x IS NOT NULL)), ',') END AS limitations FROM (
        SELECT t.key, CASE WHEN t.scope IS NULL OR t.aspect = 'nothing' THEN 'untraceable' WHEN j.aspect IS NULL THEN 'no_candidate' WHEN j.reason IS NOT NULL THEN 'rejected' ELSE 'produced' END AS outcome,
          CASE WHEN t.scope IS NULL THEN 'identity' WHEN t.aspect = 'nothing' THEN NULL WHEN s.cell_authors IS NULL THEN 'identity' WHEN j.aspect IS NULL THEN 'polarity' WHEN j.reason IS NOT NULL THEN 'sufficiency' END AS gate,
          CASE WHEN t.scope IS NULL THEN 'unknown_option' WHEN t.aspect = 'nothing' THEN 'aspect_outside_taxonomy' WHEN s.cell_authors IS NULL THEN 'empty_cell' WHEN j.aspect IS NULL THEN 'no_tagged_mention' ELSE j.reason END AS reason,
          CASE WHEN t.scope IS NOT NULL AND t.aspect <> 'nothing' THEN j.direction END AS direction, CASE WHEN t.scope IS NOT NULL AND j.aspect IS NOT NULL AND j.reason IS NULL THEN j.direction = t.want END AS direction_match,
          CASE WHEN o.product_id IS NOT NULL THEN 'renewal_unobserved' END AS r, l1, l2, CASE WHEN j.reason IS NULL AND least(j.pos, j.neg) = 1 THEN 'single_dissent' END AS d1
        FROM resolved t LEFT JOIN sizes s ON s.product_id = t.product_id || '~' || t.scope AND s.axis = t.axis AND s.segment = t.segment
        LEFT JOIN scope_judged j ON j.product_id = t.product_id || '~' || t.scope AND j.axis = t.axis AND j.segment = t.segment AND j.aspect = t.aspect
        LEFT JOIN scope_limits l ON l.product_id = t.product_id || '~' || t.scope AND l.axis = t.axis AND l.segment = t.segment AND l.aspect = t.aspect LEFT JOIN open_renewal o ON o.product_id = t.product_id || '~' || t.scope)""",
    "scoped_fates": f"""{SCOPED}, cited AS (SELECT key, product_id, scope, unnest([key, key + 10, key + 1]) AS review_id FROM resolved WHERE scope IS NOT NULL)
      SELECT c.key, c.review_id, CASE WHEN g.review_id IS NULL THEN 'identity/out_of_scope' WHEN g.stop IS NOT NULL THEN 'identity/' || g.stop WHEN d.reason IS NOT NULL THEN 'duplicate/' || d.reason ELSE 'kept' END AS fate
      FROM cited c LEFT JOIN gate1 g ON g.review_id = c.review_id AND g.product_id = c.product_id AND g.scope = c.scope LEFT JOIN gate2 d ON d.review_id = c.review_id AND d.product_id = c.product_id || '~' || c.scope""",
    "parity_fields": f"""{PLAIN}, l AS (SELECT *, review_id % 1000 <> 7 AS l, review_id % 1001 <> 1 AS r FROM reviews), both_in AS (SELECT * FROM l WHERE l AND r AND review_id <> 8), n AS (SELECT CAST(NULL AS VARCHAR) AS x)
      SELECT review_id, x AS field, 'only_left' AS kind, x AS left_value, x AS right_value FROM l, n WHERE l AND NOT r UNION ALL SELECT review_id, x, 'only_right', x, x FROM l, n WHERE r AND NOT l AND review_id <> 8 UNION ALL
      SELECT 8, x, 'repeated_key', x, x FROM n WHERE EXISTS (SELECT 1 FROM l WHERE review_id = 8) UNION ALL SELECT NULL, 'extra', 'only_right', x, x FROM n UNION ALL
      SELECT review_id, 'raw.rating', 'differs', CAST(rating AS VARCHAR), CAST(rating + 1 AS VARCHAR) FROM both_in WHERE review_id % 100 = 0 UNION ALL SELECT review_id, 'raw.more.review_date', 'differs', review_date, '1970.01.01' FROM both_in WHERE review_id % 350 = 0 UNION ALL
      SELECT review_id, 'troubles', 'differs', '["' || array_to_string(troubles, '","') || '"]', '[]' FROM both_in WHERE review_id % 600 = 5 AND len(troubles) > 0 UNION ALL
      SELECT review_id, 'skin_type', 'differs', skin_type, NULL FROM both_in WHERE review_id % 500 = 3 AND skin_type IS NOT NULL""",
    "layout_rows": f"""{RANKED_MEMBER}, {QUOTES}, {KEPT}, t AS (SELECT product_id, axis, segment, aspect, count(*) AS total, min(month) AS first_month, max(month) AS last_month FROM member JOIN tags USING (review_id) GROUP BY ALL),
      k AS (SELECT product_id, axis, segment, aspect, CAST(count(*) AS INTEGER) AS shown, coalesce(string_agg(CASE WHEN reserved THEN CAST(review_id AS VARCHAR) END, ',' ORDER BY review_id), '') AS reserved,
        string_agg(quote_rank || ':' || polarity || ':' || review_id, ';' ORDER BY quote_rank) AS quotes FROM keeping GROUP BY ALL)
      SELECT c.product_id, c.axis, c.segment, c.aspect, c.axis || '=' || c.segment AS subject, total, shown, total - shown AS omitted, first_month, last_month, reserved, quotes,
        CASE WHEN pos > 0 AND neg > 0 THEN 'mixed' WHEN pos > 0 THEN 'positive' WHEN neg > 0 THEN 'negative' ELSE 'neutral' END AS direction, spoke,
        pos + neg <= spoke AND spoke <= cell_authors AND cell_authors >= 8 AND pos + neg >= 8 AND (pos + neg) / spoke >= 0.10 AS passed, cell_authors - spoke AS silent
      FROM claims c JOIN t USING (product_id, axis, segment, aspect) JOIN k USING (product_id, axis, segment, aspect)""",
    "layout_contract": f"""{MEMBER}, s AS (SELECT product_id, axis, segment, count(*) AS reviews FROM member GROUP BY ALL),
      r AS (SELECT product_id, axis, segment, aspect, count(*) AS q, count(*) FILTER (polarity = 'positive') AS p, count(*) FILTER (polarity = 'negative') AS n, count(*) FILTER (polarity = 'neutral') AS u FROM member JOIN tags USING (review_id) GROUP BY ALL),
      x AS (SELECT * FROM claims JOIN r USING (product_id, axis, segment, aspect) JOIN s USING (product_id, axis, segment))
      SELECT product_id, axis, segment, aspect, unnest(list_filter([CASE WHEN q <> spoke THEN 'quotes_are_not_spoke' END, CASE WHEN pos <> p THEN 'pos_differs' END, CASE WHEN neg <> n THEN 'neg_differs' END, CASE WHEN neu <> u THEN 'neu_differs' END,
        CASE WHEN cell_authors - spoke <> reviews - q THEN 'silent_differs' END], lambda v: v IS NOT NULL)) AS violation FROM x""",
    "swap_backfill": """SELECT vec_id, CASE WHEN vec_id % 10 = 9 THEN 'no_stamp' WHEN vec_id % 10 = 8 THEN 'other_release' WHEN vec_id % 10 >= 4 THEN 'old_release' WHEN vec_id % 10 IN (1, 2) THEN 'broken' ELSE 'done' END AS state FROM embeddings""",
    "swap_state": """SELECT count(*) AS vectors, count(*) FILTER (vec_id % 10 NOT IN (0, 3)) AS remaining, 'vectors,golden' AS pending, false AS complete FROM embeddings""",
    "generation_meta": f"""{ALL}, g AS (SELECT axis, spoke % 3 < 2 AS skipped FROM judged WHERE reason IS NULL)
      SELECT axis, count(*) AS targets, count(*) FILTER (NOT skipped) AS produced, count(*) FILTER (skipped) AS skipped, round(100.0 * count(*) FILTER (NOT skipped) / count(*), 2) AS produced_percent FROM g GROUP BY ROLLUP (axis)""",
    "skip_reasons": f"{ALL} SELECT CASE spoke % 3 WHEN 0 THEN 'model' ELSE 'quote gate' END AS reason, count(*) AS n FROM judged WHERE reason IS NULL AND spoke % 3 < 2 GROUP BY 1",
    "vector_stamps": """SELECT vec_id, 'no_stamp' AS violation FROM embeddings WHERE vec_id % 20 = 1 UNION ALL SELECT vec_id, 'other_model' FROM embeddings WHERE vec_id % 20 = 2 UNION ALL SELECT vec_id, 'other_version' FROM embeddings WHERE vec_id % 20 = 2 UNION ALL
      SELECT vec_id, 'wrong_dimension' FROM embeddings WHERE vec_id % 20 = 3 UNION ALL SELECT vec_id, 'not_finite' FROM embeddings WHERE vec_id % 20 = 4""",
    "golden_misses": f"{ALL}, {TRACE} SELECT outcome, gate, reason, count(*) AS n FROM traced WHERE outcome <> 'produced' GROUP BY 1, 2, 3",
    "claim_order": f"""{MEMBER} SELECT product_id, axis, segment, aspect, row_number() OVER (ORDER BY product_id, CASE axis WHEN 'product' THEN 0 WHEN 'skinType' THEN 1 ELSE 2 END, segment, aspect) AS position FROM claims""",
    "conflict_order": f"{PLAIN}, {CONFLICTS} SELECT review_id, aspect, kind, row_number() OVER (ORDER BY review_id, aspect) AS position FROM conflicts",
    "split_order": f'{MEMBER}, {SPLITS} SELECT product_id, axis, aspect, "left", "right", row_number() OVER (ORDER BY product_id, axis, "left", "right", aspect) AS position FROM splits WHERE split',
    "count_order": f"{PLAIN} SELECT aspect, polarity, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, aspect, polarity) AS position FROM tags GROUP BY 1, 2",
    "stage_order": """SELECT o_orderkey AS id, CASE o_orderkey % 6 WHEN 2 THEN 'stage_number' WHEN 3 THEN 'no_stages' ELSE 'stage_order' END AS violation FROM orders WHERE o_orderkey % 6 < 4""",
    "crawl_contract": "SELECT 'new' || l_linenumber AS field, count(*) AS rows FROM lineitem WHERE l_linenumber > 3 GROUP BY 1",
}
