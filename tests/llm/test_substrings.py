import random

from veridact.llm import substrings as S


def brute(docs):
    """docs: (id, text) in order of first. Kept texts, by looking at every span in order."""
    seen, gone = set(), {}
    long_enough = lambda run: sum(p[3] for p in run) >= 30 or len(run) >= 3 and sum(p[3] for p in run) >= 15
    for d, (_, text) in enumerate(docs):
        parts = S.sentences(text or "")
        n = len(parts)
        shortest = [(i, next((j for j in range(i + 1, n + 1) if long_enough(parts[i:j])), None)) for i in range(n)]
        shortest += [(next((i for i in range(j - 1, -1, -1) if long_enough(parts[i:j])), None), j) for j in range(1, n + 1)]
        ranges = {r for r in shortest if None not in r}
        for i, j in sorted(ranges):
            key = b" ".join(p[2] for p in parts[i:j])
            if key in seen:
                gone.setdefault(d, set()).update(range(i, j))
            seen.add(key)
    out = []
    for d, (i, text) in enumerate(docs):
        for k in sorted(gone.get(d, ()), reverse=True):
            s, e = S.sentences(docs[d][1])[k][:2]
            text = text[:s] + text[e:]
        out.append((i, text, len(gone.get(d, ()))))
    return out


def prose(rnd, n):
    words = lambda: " ".join(rnd.choice("abcdefgh") * rnd.randint(1, 5) for _ in range(rnd.randint(1, 14)))
    return "".join(words() + rnd.choice([". ", "! ", "?\n", "...\n", " é. "]) for _ in range(n))


def test_matches_brute_force(spark):
    rnd = random.Random(3)
    passages = [prose(rnd, 6) for _ in range(4)]
    docs = [(i, prose(rnd, rnd.randint(0, 8)) + rnd.choice([*passages, ""]) + prose(rnd, rnd.randint(0, 5))) for i in range(60)]
    docs += [(60, passages[0]), (61, passages[0] * 3), (62, ""), (63, None), (64, " \n "), (65, "no end " * 400), (66, "no end " * 400)]
    df = spark.createDataFrame([(i, t, "r", 7) for i, t in docs], "doc_id long, text string, removed string, cover int")
    got = S.dedup(df)
    assert got.columns == ["doc_id", "text", "cover", "n_sentences", "n_removed", "removed"]
    assert [(r.doc_id, r.text, r.n_removed) for r in got.orderBy("doc_id").collect()] == brute(docs)


def test_offsets_restore_the_text(spark):
    text = "One two three four five. Six seven eight nine ten. Eleven twelve thirteen fourteen fifteen."
    got = S.dedup(spark.createDataFrame([(1, text), (2, "Own start here. " + text + " Own end.")], "doc_id long, text string")).orderBy("doc_id").collect()
    assert got[0].text == text and got[0].removed == []
    whole = "Own start here. " + text + " Own end."
    assert got[1].text == "Own start here. Own end."
    assert "".join(whole[r.start : r.end] for r in got[1].removed) == " " + text


def test_null_ids_come_last_and_equal_rows_are_one(spark):
    text = "One two three four five. Six seven eight nine ten. Eleven twelve thirteen fourteen fifteen."
    got = S.dedup(spark.createDataFrame([(None, text), (3, text), (3, text)], "doc_id long, text string")).collect()
    assert sorted((r.doc_id is None, r.text) for r in got) == [(False, text), (False, text), (True, "")]


def test_empty_table(spark):
    assert S.dedup(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_repeated_passages_of_long_sentences_go_whole(spark):
    """Passages of few long sentences between texts of their own leave nothing behind."""
    rnd = random.Random(8)
    words = lambda n: " ".join("".join(rnd.choice("abcdefghijklmnop") for _ in range(7)) for _ in range(n)) + ". "
    docs, want = [], []
    for sizes in [(31, 25), (27, 5, 5, 1), (20, 20, 12), (12, 9, 29), (31, 2, 2), (6, 7, 8, 3)]:
        passage = "".join(map(words, sizes))
        # where words are glued to it, the first sentence is another one, and the others still repeat
        left = sizes[1:]
        glued = len(left) if sum(left) >= 30 or len(left) >= 3 and sum(left) >= 15 else 0
        for glue, n in (("", 0), ("", len(sizes)), ("glued words ", glued)):
            docs.append((len(docs), words(9) + glue + passage + words(14)))
            want.append(n)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert [r.n_removed for r in S.dedup(df).orderBy("doc_id").collect()] == want
