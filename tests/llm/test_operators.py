"""Whole operators on small tables against brute force, with nulls, empties, repeats, ties and clashing columns."""

import itertools
import os
import random
import re

import pytest
from lexforge.llm import cooccurrence, eval_leaks, mixing, near_duplicates, noise, repetition, shared_spans, splitting
from pyspark.sql import functions as F

WORDS = [a + b for a in ("ba", "ke", "li", "mo", "nu", "ra") for b in ("ton", "ver", "sil", "dor", "mak", "pel")]
#: Where the public vocabularies are in tests.
VOCABULARY = os.environ.get("LEXFORGE_TOKENIZER", "/opt/tokenizers/byte_bpe_50k.tiktoken")
EXTRA = "key string, text string, rid string, a string, n string, lang string, id2 int"


def table(spark, rows, key="id", text="t"):
    """With columns whose names the operators use inside."""
    return spark.createDataFrame([(k, t, "x", "y", "z", "w", "v", 1) for k, t in rows], f"{key} string, {text} string, key string, rid string, a string, n string, lang string, id2 int")


def texts(seed, n, length=60):
    r = random.Random(seed)
    out = [" ".join(r.choice(WORDS) for _ in range(length)) for _ in range(n)]
    for i in range(0, n, 3):  # small edits of the one before
        w = out[i - 1].split()
        for _ in range(r.randrange(1, 8)):
            w[r.randrange(len(w))] = r.choice(WORDS)
        out[i] = " ".join(w)
    return out


def shingles(t, k):
    w = re.findall(r"[^\W_]+", (t or "").lower())
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}, len(w)


DIRT = [(None, "null key"), ("e1", None), ("e2", ""), ("e3", "  \n"), ("s1", "too short")]


def test_near_duplicates_against_all_pairs(spark):
    rows = [(f"k{i}", t) for i, t in enumerate(texts(1, 90))]
    rows += [("c1", rows[4][1]), ("c2", rows[4][1].upper()), rows[7], rows[7]] + DIRT
    links, members = near_duplicates.near_duplicates(table(spark, rows), "id", "t", 0.6, 3, 25)
    got = {tuple(x) for x in near_duplicates.expand_pairs(links, members).collect()}
    s = {k: shingles(t, 3)[0] for k, t in rows if k and shingles(t, 3)[1] >= 25}
    want = {(a, b) for a, b in itertools.combinations(sorted(s), 2) if len(s[a] & s[b]) >= 0.6 * len(s[a] | s[b])}
    clear = {(a, b) for a, b in want if len(s[a] & s[b]) >= 0.65 * len(s[a] | s[b])}  # candidates are found with a probability that grows with likeness
    assert got <= want and clear <= got and len(got) >= 0.9 * len(want) and len(want) > 20
    assert {x["class_key"] for x in members.where("key in ('k4', 'c1', 'c2')").collect()} == {min(members.where("key in ('k4', 'c1', 'c2')").select("class_key").first())}


def test_near_duplicates_hot_group_and_empty(spark):
    t = texts(2, 2)
    rows = [(f"h{i:04}", t[1]) for i in range(1500)] + [(f"k{i}", x) for i, x in enumerate(texts(3, 30))]
    links, members = near_duplicates.near_duplicates(table(spark, rows), "id", "t")
    assert members.where("key like 'h%'").select("class_key").distinct().count() == 1 and members.count() == 1530
    empty = near_duplicates.near_duplicates(table(spark, rows).limit(0), "id", "t")
    assert empty[0].count() == 0 and empty[1].count() == 0


def test_shared_spans(spark):
    r = random.Random(4)
    mk = lambda n: [r.choice(WORDS) + str(r.randrange(50)) for _ in range(n)]
    span, long = mk(35), mk(130)
    docs = [mk(80) for _ in range(40)]
    docs[3][10:10] = span
    docs[9][50:50] = span
    docs[20] = long
    docs[21] = mk(5) + long + mk(5)
    docs[30] += docs[30][:40]  # only inside itself
    rows = [(f"k{i}", ("\n" if i % 2 else " ").join(d)) for i, d in enumerate(docs)] + [("k3", " ".join(docs[3]))] + DIRT
    df = table(spark, rows)
    assert {x.key for x in shared_spans.records_with_shared_span(df, "id", "t", 30).collect()} == {"k3", "k9", "k20", "k21"}
    s = {x.key: x for x in shared_spans.shared_spans(df, "id", "t", 30).collect()}
    assert s["k3"].shared_tokens == 35 and s["k3"].tokens == 115 and s["k3"].level == 30 and s["k20"].shared_share == 1.0 and s["k20"].level == 120
    assert shared_spans.records_with_shared_span(df.limit(0), "id", "t").count() == 0


def test_shared_spans_hot_passage(spark):
    hot = " ".join(f"w{i}" for i in range(30))
    rows = [(f"k{i}", f"a{i} {hot} b{i}" if i % 3 == 0 else f"c{i} d{i}") for i in range(6000)]
    assert shared_spans.records_with_shared_span(table(spark, rows).repartition(4), "id", "t", 30).count() == 2000


def test_eval_leaks(spark):
    item = "How many tonnes of Velmora wheat did 14 farms in Castelby sell within 30 days after the auction of March ended there?"
    other = " ".join(WORDS[:20])
    items = spark.createDataFrame([(1, item, "x"), (2, other, "x"), (3, "short", "x"), (4, None, "x"), (None, "", "x")], "item_id int, text string, id string")
    rep = item.replace("14", "15").replace("30", "99")
    docs = [(1, "Intro: " + item.upper().replace(" ", "\n ") + " end"), (2, "x " + ", ".join(WORDS[2:18])), (3, " ".join(WORDS[:14])), (4, rep), (5, item.replace("14", "other")), (6, None), (7, ""), (1, "Intro: " + item)]
    d = spark.createDataFrame(docs, "doc_id int, text string").withColumns({"id": F.lit("q"), "tmpl": F.lit(1)})
    want = {(1, 1, "verbatim"), (2, 2, "verbatim"), (4, 1, "reparameterised")}
    got = {tuple(x) for x in eval_leaks.leaked_items(d, "doc_id", "text", items, "item_id", "text").collect()}
    assert want <= got and {x for x in got - want if x[2] == "verbatim"} == {(4, 1, "verbatim")} - {(4, 1, "verbatim")}
    wide = {tuple(x) for x in eval_leaks.leaked_items(d, "doc_id", "text", items, "item_id", "text", blocks=1, max_broadcast=0).collect()}
    assert wide == got  # a bitmap that is nearly full, and joined by a shuffle
    assert eval_leaks.leaked_items(d.limit(0), "doc_id", "text", items, "item_id", "text").count() == 0
    assert eval_leaks.leaked_items(d, "doc_id", "text", items.limit(0), "item_id", "text").count() == 0


def test_repetition(spark):
    r = random.Random(6)
    prose = lambda n: " ".join(r.choice(WORDS) for _ in range(n))
    say = prose(12)
    rows = [(i, prose(80), "eng" if i % 2 else " EN") for i in range(120)] + [(500, " ".join([say] * 10), "fra"), (501, prose(40) + " " + " ".join([say] * 4), None), (502, "a " * 100, "eng"), (503, "short short", "eng"), (504, None, "eng"), (505, "", None), (500, " ".join([say] * 10), "fra")]
    d = spark.createDataFrame(rows, "doc_id int, text string, lang string").withColumn("words", F.lit("x"))
    want = set()
    for i, t, _ in rows:
        w = re.findall(r"[^\W_]+", (t or "").lower())
        g = [tuple(w[j : j + 5]) for j in range(len(w) - 4)]
        if len(w) >= 50 and 1 - len(set(g)) / len(g) >= 0.25:
            want.add(i)
    assert {x.doc_id for x in repetition.repetitive(d, "doc_id", "text", "lang").collect()} == want == {500, 501, 502}
    assert repetition.repetitive(d.limit(0), "doc_id", "text", "lang").count() == 0
    small = repetition.judge(d, "doc_id", "text", "lang", max_bigrams=10, max_words=5)
    assert small.count() == len(rows) and small.where("doc_id = 504").first().verdict == "kept"


def test_cooccurrence(spark, monkeypatch):
    monkeypatch.setattr(cooccurrence, "BLOCK", 3)  # several blocks a record
    r = random.Random(7)
    base = {f"R{i}": {f"l{r.randrange(12)}" for _ in range(r.randrange(9))} for i in range(60)}
    rows = [(a.lower() + " ", x.upper() + "  ") for a, xs in base.items() for x in xs] * 2 + [(None, "l1"), ("R1", None), ("R1", " "), ("", "l2")]
    d = spark.createDataFrame(rows, "celex_id string, eurovoc_label string").withColumns({"r": F.lit(1), "x": F.lit(2), "n": F.lit(3), "code": F.lit(4)})
    sets = {a: xs for a, xs in base.items() if xs}
    n = {x: sum(x in s for s in sets.values()) for x in {x for s in sets.values() for x in s}}
    both = {(a, b): sum(a in s and b in s for s in sets.values()) for a, b in itertools.combinations(sorted(n), 2)}
    got = {(x.label_a, x.label_b): (x.n_both, x.n_a, x.n_b, x.n_records) for x in cooccurrence.labels_together(d, "celex_id", "eurovoc_label", 1, 0).collect()}
    assert got == {p: (c, n[p[0]], n[p[1]], len(sets)) for p, c in both.items() if c}
    lift = {(x.label_a, x.label_b) for x in cooccurrence.labels_together(d, "celex_id", "eurovoc_label", 5, 1.2).collect()}
    assert lift == {p for p, c in both.items() if c >= 5 and c * len(sets) >= 1.2 * n[p[0]] * n[p[1]]}
    assert cooccurrence.labels_together(d.limit(0), "celex_id", "eurovoc_label").count() == 0


def test_splitting(spark):
    rows = [("a", "Sentence one. " * 40), ("a", "Sentence one. " * 40), ("b", "x" * 1000), ("c", "y" * 100), *DIRT]
    out = splitting.split_oversized(table(spark, rows), "id", "t", 200, 50)
    by = {k: [x.text for x in sorted(g, key=lambda x: x.piece)] for k, g in itertools.groupby(sorted(out.collect(), key=lambda x: x.key), key=lambda x: x.key)}
    assert set(by) == {"a", "b"} and by["a"][0] + "".join(x[50:] for x in by["a"][1:]) == rows[0][1] and max(map(len, by["b"])) <= 200
    with pytest.raises(ValueError):
        splitting.split_oversized(table(spark, rows), "id", "t", 100, 100)


def test_mixing(spark):
    rows = [(i, "word " * (5 + i % 7), ["Big", " big\t", "BIG"][i % 3]) for i in range(300)] + [(1000 + i, "tiny text here", "small") for i in range(5)] + [(2000, "no part", None), (2001, "none", "other"), (2002, None, "big"), (0, "word " * 5, "Big")]
    d = spark.createDataFrame(rows, "doc_id int, text string, source string").withColumns({"id": F.lit(1), "tokens": F.lit(2), "share": F.lit(3)})
    t = spark.createDataFrame([("big", 0.5, 2), ("small", 0.5, 3), ("none", None, None), (None, 1.0, 1)], "source string, target_share double, max_repeats int")
    sel, rep = mixing.mix_sources(d, "doc_id", "text", "source", t, VOCABULARY, block=4)
    r = {x.source: x for x in rep.collect()}
    s = {x.id: x for x in sel.collect()}
    assert max(x.uses for x in s.values() if x.source == "small") <= 3 and {"2000", "2001", "2002"}.isdisjoint(s)
    assert r["small"].selected_tokens <= 3 * r["small"].available_tokens and r["none"].selected_tokens == 0
    assert abs(r["big"].selected_tokens - 4 * r["big"].blocks) <= 20 and abs(sum(x.actual_share for x in r.values()) - 1) < 1e-4
    again, _ = mixing.mix_sources(d.repartition(3), "doc_id", "text", "source", t, VOCABULARY, block=4, shard_tokens=500)
    assert abs(again.agg(F.sum(F.col("tokens") * F.col("uses"))).first()[0] - sum(x.tokens * x.uses for x in s.values())) < 80
    assert mixing.mix_sources(d.limit(0), "doc_id", "text", "source", t, VOCABULARY)[0].count() == 0


def test_noise(spark):
    r = random.Random(8)
    rows = []
    for i in range(300):
        w = [r.choice(WORDS) for _ in range(60)]
        lines = [" ".join(w[j : j + 10]) for j in range(0, 60, 10)]
        if i % 30 == 0:
            lines[2] = lines[2].rsplit(" ", 1)[0] + " " + w[29][:2] + "-"
            lines[3] = w[29][2:] + " " + lines[3]
        if i % 15 == 0:
            lines.insert(3, f"No {i} Annals of the Realm 1{i}")
        if i % 20 == 0:
            lines.insert(2, f"- {i % 90} -")
        if i % 25 == 0:
            lines[0] = lines[0].replace("l", "1", 1).replace("o", "0", 1)
        rows.append((f"k{i}", "\n".join(lines)))
    df = table(spark, rows + [rows[0]] + DIRT)
    got = {tuple(x) for x in noise.scanned_noise(df, "id", "t").collect()}
    kinds = lambda k: {a for a, b in got if b == k}
    assert kinds("hyphenation") == {f"k{i}" for i in range(0, 300, 30)}
    assert kinds("header") == {f"k{i}" for i in range(0, 300, 15)} and kinds("page_number") == {f"k{i}" for i in range(0, 300, 20)}
    want = {f"k{i}" for i in range(0, 300, 25)}
    assert len(kinds("misread") & want) >= 0.8 * len(want) and not kinds("misread") - want
    fixed = {x.key: x.text for x in noise.scanned_noise(df, "id", "t", True).collect()}
    assert len(fixed) == len({a for a, _ in got}) and "Realm" not in " ".join(fixed.values()) and "\n" not in fixed["k30"]
    assert noise.scanned_noise(df.limit(0), "id", "t").count() == 0


def _family(r, size, shared, own, same):
    """Texts that share their first words; each odd one shares more words with the one before."""
    word = lambda: "".join(r.choice("abcdefghijklmnop") for _ in range(7))
    head, out = [word() for _ in range(shared)], []
    for i in range(size):
        tail = [word() for _ in range(own)]
        if i % 2:
            tail = out[-1].split()[shared : shared + same] + tail[same:]
        out.append(" ".join(head + tail))
    return out


def test_near_duplicates_in_families_below_the_threshold(spark):
    r = random.Random(5)
    rows = [(f"f{k}-{i:02}", t) for k in range(6) for i, t in enumerate(_family(r, 60, 152, 60, 24))]
    s = {k: shingles(t, 3)[0] for k, t in rows}
    like = lambda a, b: len(s[a] & s[b]) / len(s[a] | s[b])
    want = {(f"f{k}-{i:02}", f"f{k}-{i + 1:02}") for k in range(6) for i in range(0, 60, 2)}
    assert min(like(*p) for p in want) > 0.7 and like("f0-00", "f0-02") < 0.59
    for block in ({}, {"block": 4}):  # whole hubs, and hubs in blocks
        links, _ = near_duplicates.near_duplicates(table(spark, rows), "id", "t", 0.65, 3, 25, **block)
        assert {(x.key_a, x.key_b) for x in links.collect()} == want


def test_repetition_scores_are_the_same_beyond_the_bounds(spark):
    rows = [(i, t, "en") for i, t in enumerate(texts(7, 60))] + [(100, "only " + texts(8, 1)[0], None), (101, None, "en"), (102, "", "en"), (103, "rare " + texts(9, 1)[0], "en")]
    d = spark.createDataFrame(rows, "doc_id int, text string, lang string")
    one, two = ({r.doc_id: r for r in repetition.scores(d, "doc_id", "text", "lang", **b).collect()} for b in ({}, {"max_bigrams": 10, "max_words": 5}))
    assert len(one) == len(two) == len(rows)
    assert all(one[k][c] == pytest.approx(two[k][c], abs=1e-9) for k in one for c in ("lang", "words", "windows", "log_ppl", "log_ppl_corpus", "ratio", "share"))


def test_more_headings_than_the_former_cap(spark):
    words = ["".join(w) for w in itertools.islice(itertools.product("gjkpsxz", repeat=6), 50_100)]  # no glyph edits
    lines = ["".join(f"it goes\nHead {w}\non so\n" for w in words[i::100]) for i in range(100)]
    d = spark.createDataFrame([(t,) for t in lines * 5], "text string").repartition(4)
    assert len(noise.fit(d).lexicon.headings) == 50_100


def test_near_duplicate_groups_are_the_components_of_the_links(spark):
    r = random.Random(11)
    rows = [(f"k{i}", t) for i, t in enumerate(texts(12, 60))] + [(f"f-{i:02}", t) for i, t in enumerate(_family(r, 40, 152, 60, 24))] + DIRT
    rows += [("c1", rows[4][1]), ("c2", rows[4][1])]
    for block in ({}, {"block": 4}):
        links, members = near_duplicates.near_duplicates(table(spark, rows), "id", "t", 0.65, 3, 25, **block)
        pairs = [tuple(x) for x in near_duplicates.expand_pairs(links, members).collect()]
        at = {k: k for p in pairs for k in p}
        for _ in at:
            for a, b in pairs:
                at[a] = at[b] = min(at[a], at[b])
        got = {x.key: (x.group_key, x.group_size) for x in near_duplicates.groups(table(spark, rows), "id", "t", 0.65, 3, 25, **block).collect()}
        assert got == {k: (g, sum(v == g for v in at.values())) for k, g in at.items()} and len(got) > 40


def test_shared_spans_with_a_bitmap_that_is_full(spark):
    r = random.Random(14)
    rows = [(f"k{i}", " ".join(r.choice(WORDS) for _ in range(90))) for i in range(60)]
    rows += [(f"m{i}", " ".join(t.split()[20 : 50 + i]) + f" own{i}") for i, (_, t) in enumerate(rows[:30])]
    src = shared_spans._source(table(spark, rows), "id", "t", None).select("rid", "apart", "text")
    one, two = ({tuple(x) for x in shared_spans.shared_windows(src, 30, b).collect()} for b in (1 << 23, 1))
    assert one == two and len({x[1] for x in one}) == 60


def test_slots_are_consistent_over_a_whole_copy(spark):
    rows = [(1, 0, [0, 5, 0, 5], [0, 5, 0, 5]), (2, 0, [0, 6, 0, 6], [0, 5, 0, 5]), (3, 0, [0, 6, 0, 7], [0, 5, 0, 5]), (4, 0, [0, 6], [0, 5]), (4, 0, [7, 0], [5, 0]), (5, 0, [6, 0], [5, 0]), (5, 9, [7, 0], [5, 0])]
    hits = spark.createDataFrame([(i, 1, c, a, b) for i, c, a, b in rows], "id long, item_id long, copy int, slots array<long>, item_slots array<long>")
    got = {(x.id, x.kind) for x in eval_leaks.slot_kinds(hits).collect()}
    assert got == {(1, "verbatim"), (2, "reparameterised"), (5, "reparameterised")}  # 4: one copy, two words for one; 5: two copies


def test_planted_reparameterised_leaks(spark):
    r = random.Random(21)
    items, docs, want = [], [], set()
    for i in range(40):
        w = [r.choice(WORDS) for _ in range(24)]
        for j in (4, 11, 19):
            w[j] = str(r.randrange(1000))
        items.append((i, " ".join(w)))
        if i % 2:
            v = list(w)
            for j in (4, 11, 19):
                v[j] = str(1000 + 7 * i + j)
            docs.append((100 + i, "before " + ", ".join(v) + " after"))
            want.add((100 + i, i, "reparameterised"))
        docs.append((i, " ".join(r.choice(WORDS) for _ in range(80))))
    d, it = spark.createDataFrame(docs, "doc_id int, text string"), spark.createDataFrame(items, "item_id int, text string")
    assert {tuple(x) for x in eval_leaks.leaked_items(d, "doc_id", "text", it, "item_id", "text").collect()} == want


def test_one_record_with_many_items(spark):
    rows = [("big", f"l{i:04}") for i in range(1500)] + [("small", "l0001"), ("small", "l0002")]
    d = spark.createDataFrame(rows, "celex_id string, eurovoc_label string")
    out = cooccurrence.labels_together(d, "celex_id", "eurovoc_label", 1, 0)
    n = out.agg(F.count(F.lit(1)).alias("n"), F.sum("n_both").alias("s")).first()
    assert n.n == 1500 * 1499 // 2 and n.s == n.n + 1


def test_a_word_that_only_looks_like_another_one_is_no_noise(spark):
    """'horder' stands where 'border' does, 'hulk' stands in contexts of its own and not in those of 'bulk'."""
    r = random.Random(31)
    a, b = [[x + y for y in ("ton", "ver", "sil", "dor", "mak", "pel")] for x in ("ba", "zu")]
    say = lambda ws, w: " ".join([r.choice(ws), r.choice(ws), w, r.choice(ws), r.choice(ws)])
    rows = [(f"k{i}", " ".join(say(a, "border") for _ in range(4)) + " . . " + " ".join(say(a, "bulk") for _ in range(4)) + " . . " + " ".join(say(b, "quiet") for _ in range(4))) for i in range(200)]
    rows += [("x", say(a, "horder")), ("y", " . . ".join(say(b, "hulk") for _ in range(2)))]
    df = table(spark, rows)
    got = {tuple(x) for x in noise.scanned_noise(df, "id", "t").collect()}
    assert got == {("x", "misread")}
    assert {x.key: x.text.split()[2] for x in noise.scanned_noise(df, "id", "t", True).collect()} == {"x": "border"}
