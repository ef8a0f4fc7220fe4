"""Substring dedup over sliding spans of sentences.

A text is cut into sentences at . ! ? and line ends; the pieces joined give the text again. A run
of consecutive sentences counts from three of them with 15 words, or from 30 words. The shortest
such run that starts at every sentence and the shortest that ends at every sentence are spans: any
longer run is made of them, and every sentence of a repeated run lies in a span inside that run.
Spans are hashed to 96 bits, equal hashes meet in one global aggregation, and every sentence that
lies in a span which isn't the first of its kind is removed. First means the smallest (id, row key,
sentence); null ids come last.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, slices

SENTENCE = re.compile(r"[^.!?\n]+[.!?\n]*|[.!?\n]+")
SPAN_SENTENCES, SPAN_WORDS, LONG_WORDS = 3, 15, 30


def sentences(text: str) -> list[tuple[int, int, bytes, int]]:
    """(start, end, words joined by a space, number of words) of each piece that has a word."""
    found = []
    for m in SENTENCE.finditer(text):
        words = m.group().encode("utf-8").split()
        if words:
            found.append((m.start(), m.end(), b" ".join(words), len(words)))
    return found


def _runs(sizes: list[int]) -> Iterator[tuple[int, int]]:
    """(first, end) of the shortest long enough run that starts at each place; both ends move forwards only."""
    end = words = 0
    for i, size in enumerate(sizes):
        while end < len(sizes) and not (words >= LONG_WORDS or end - i >= SPAN_SENTENCES and words >= SPAN_WORDS):
            words += sizes[end]
            end += 1
        if not (words >= LONG_WORDS or end - i >= SPAN_SENTENCES and words >= SPAN_WORDS):
            return
        yield i, end
        words -= size


def spans(text: str) -> Iterator[tuple[int, int, int]]:
    """(first sentence, number of sentences, 128-bit hash) of every span, each range once."""
    parts = sentences(text)
    sizes = [p[3] for p in parts]
    n = len(sizes)
    for i, end in dict.fromkeys([*_runs(sizes), *((n - e, n - i) for i, e in _runs(sizes[::-1]))]):
        yield i, end - i, xxhash.xxh3_128_intdigest(b" ".join(p[2] for p in parts[i:end]))


def span_table(docs: DataFrame) -> DataFrame:
    """docs: id, row (long), text. (h, g, id, row, at, n) of every span, in one pass; h and g are its hash."""
    kind = docs.schema["id"].dataType.simpleString()
    names = ["h", "g", "id", "row", "at", "n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            ids, rows = b.column(0), b.column(1)
            own, out = [], ([], [], [], [])
            for k, text in enumerate(b.column(2).to_pylist()):
                for at, n, hashed in spans(text or ""):
                    own.append(k)
                    out[0].append((hashed & (1 << 64) - 1) - (1 << 63))
                    out[1].append((hashed >> 64 & (1 << 32) - 1) - (1 << 31))
                    out[2].append(at)
                    out[3].append(n)
            take = pa.array(own, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int32()), ids.take(take), rows.take(take), pa.array(out[2], pa.int32()), pa.array(out[3], pa.int32())], names
            )

    return docs.select("id", "row", "text").mapInArrow(run, f"h long, g int, id {kind}, row long, at int, n int")


def repeated(docs: DataFrame) -> DataFrame:
    """(id, row, cover array<struct<at,n>>): the spans of a row that aren't the first of their kind."""
    all_spans = span_table(docs)
    first = materialize(
        all_spans.groupBy("h", "g")
        .agg(F.count("*").alias("c"), F.min(F.struct(F.col("id").isNull().alias("z"), "id", "row", "at")).alias("low"))
        .where("c > 1").select("h", "g", "low")
    )
    own = (F.col("id").eqNullSafe(F.col("low.id"))) & (F.col("row") == F.col("low.row")) & (F.col("at") == F.col("low.at"))
    later = all_spans.join(first, ["h", "g"]).where(~own)
    # a row's spans are bounded by its own length
    return later.groupBy("id", "row").agg(F.collect_set(F.struct("at", "n")).alias("cover"))


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with text_col rewritten, and with n_sentences, n_removed int and removed array<struct<start,end>>.

    Offsets are code points of the original text, end exclusive, one for each removed sentence.
    Defined cases: null texts stay null and count no sentences; texts without a full span are never
    touched; rows equal in id and text are one and the same and come out alike; repeats inside a
    text go too; null ids come last in the order of first; an empty table gives an empty result.
    Other columns pass through; one named like an added column is replaced by it.
    """
    added = ("n_sentences", "n_removed", "removed")
    rest = [c for c in docs.columns if c not in (text_col, *added)]
    row = F.xxhash64(F.col(id_col), F.col(text_col))
    cover = repeated(docs.select(F.col(id_col).alias("id"), row.alias("row"), F.col(text_col).alias("text")))
    packed = docs.select(F.col(id_col).alias("_id"), row.alias("_row"), F.struct(*rest).alias("_rest"), F.col(text_col).alias("_text"))
    joined = packed.join(cover, F.col("_id").eqNullSafe(F.col("id")) & (F.col("_row") == F.col("row")), "left").select("_rest", "_text", "cover")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        for b in slices(batches):
            texts, counts, gone = [], [], []
            for text, covered in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                parts = sentences(text or "")
                bad = sorted({i for c in covered or () for i in range(c["at"], c["at"] + c["n"])})
                cut = [parts[i][:2] for i in bad]
                if cut:
                    ends = [0, *(e for _, e in cut)]
                    text = "".join(text[e:s] for e, s in zip(ends, [*(s for s, _ in cut), len(text)]))
                texts.append(text)
                counts.append(len(parts))
                gone.append([{"start": s, "end": e} for s, e in cut])
            removed = pa.array([len(g) for g in gone], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(texts, pa.string()), pa.array(counts, pa.int32()), removed, pa.array(gone, kinds)],
                ["_rest", "_new", *added],
            )

    rest_kind = joined.schema["_rest"].dataType.simpleString()
    out = joined.mapInArrow(run, f"_rest {rest_kind}, _new string, n_sentences int, n_removed int, removed array<struct<start:int,end:int>>")
    columns = [F.col("_new").alias(c) if c == text_col else F.col(f"_rest.`{c}`") for c in docs.columns if c not in added]
    return out.select(*columns, *added)


#: DuckDB SQL for the query on documents.
ORACLE = """
WITH pieces AS (
  SELECT doc_id, text, unnest(regexp_extract_all(coalesce(text, ''), '[^.!?\\n]+[.!?\\n]*|[.!?\\n]+')) AS piece,
         generate_subscripts(regexp_extract_all(coalesce(text, ''), '[^.!?\\n]+[.!?\\n]*|[.!?\\n]+'), 1) AS pos
  FROM documents
), worded AS (
  SELECT doc_id, text, piece, pos, regexp_extract_all(piece, '[^\\x20\\x09-\\x0D]+') AS w FROM pieces
), sent AS (
  SELECT doc_id, text, pos, array_to_string(w, ' ') AS s, len(w) AS n,
         row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS i,
         sum(len(w)) OVER (PARTITION BY doc_id ORDER BY pos) AS cum
  FROM worded WHERE len(w) > 0
), ends AS (
  SELECT a.doc_id, a.i, min(b.i) AS last
  FROM sent a JOIN sent b ON a.doc_id = b.doc_id AND b.i BETWEEN a.i AND a.i + 30
  WHERE b.cum - a.cum + a.n >= 30 OR (b.i - a.i >= 2 AND b.cum - a.cum + a.n >= 15)
  GROUP BY 1, 2
), starts AS (
  SELECT b.doc_id, max(a.i) AS i, b.i AS last
  FROM sent b JOIN sent a ON a.doc_id = b.doc_id AND a.i BETWEEN b.i - 30 AND b.i
  WHERE b.cum - a.cum + a.n >= 30 OR (b.i - a.i >= 2 AND b.cum - a.cum + a.n >= 15)
  GROUP BY b.doc_id, b.i
), ranges AS (SELECT doc_id, i, last FROM ends UNION SELECT doc_id, i, last FROM starts),
runs AS (
  SELECT e.doc_id, e.i, e.last, string_agg(s.s, ' ' ORDER BY s.i) AS span
  FROM ranges e JOIN sent s ON s.doc_id = e.doc_id AND s.i BETWEEN e.i AND e.last
  GROUP BY 1, 2, 3
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY span ORDER BY doc_id, i) AS k FROM runs
), gone AS (
  SELECT DISTINCT s.doc_id, s.pos FROM ranked r JOIN sent s ON s.doc_id = r.doc_id AND s.i BETWEEN r.i AND r.last
  WHERE r.k > 1
), kept AS (
  SELECT p.doc_id, coalesce(string_agg(CASE WHEN g.pos IS NULL THEN p.piece END, '' ORDER BY p.pos), '') AS text,
         count(g.pos) AS n_removed
  FROM pieces p LEFT JOIN gone g ON g.doc_id = p.doc_id AND g.pos = p.pos GROUP BY 1
), counted AS (SELECT doc_id, count(*) AS n FROM sent GROUP BY 1)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text,
       CAST(coalesce(c.n, 0) AS INTEGER) AS n_sentences, CAST(coalesce(k.n_removed, 0) AS INTEGER) AS n_removed
FROM documents d LEFT JOIN kept k ON k.doc_id = d.doc_id LEFT JOIN counted c ON c.doc_id = d.doc_id
"""
