"""Kernels against plain versions of themselves."""

import random
import re
import string

import numpy as np
from hypothesis import given, settings, strategies as st
from lexforge.llm import cooccurrence, eval_leaks, hashing as H, mixing, near_duplicates as N, noise, repetition, shared_spans as S, splitting

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="aAbß1_ é\n\t,.ﬁ中-", max_size=40)), max_size=6)


@settings(max_examples=150, deadline=None)
@given(TEXTS, st.sampled_from(["word", "token"]))
def test_word_hashes_mirror_words(texts, kind):
    h, off = H.hash_words(texts, kind)
    plain = [re.findall(r"[^\W_]+", (t or "").lower()) if kind == "word" else (t or "").split() for t in texts]
    assert np.diff(off).tolist() == [len(p) for p in plain] if texts else len(off) == 1
    flat = [w for p in plain for w in p]
    assert len(set(h.tolist())) == len(set(flat)) and len(set(zip(flat, h.tolist()))) == len(set(flat))


def test_chunks_do_not_change_hashes(monkeypatch):
    r = random.Random(1)
    texts = ["".join(r.choice("ab \n") for _ in range(300)) for _ in range(5)] + ["x" * 500, "", "y" * 90 + " z"]
    a = H.hash_words(texts), H.hash_words(texts, "token")
    monkeypatch.setattr(H, "CHUNK", 64)
    b = H.hash_words(texts), H.hash_words(texts, "token")
    for (h1, o1), (h2, o2) in zip(a, b):
        assert np.array_equal(h1, h2) and np.array_equal(o1, o2)


def test_windows_equal_iff_words_equal():
    r = random.Random(2)
    words = [r.choice("abc") for _ in range(400)]
    h, _ = H.hash_words([" ".join(words)])
    for k in (1, 3, 5, 9, 15):
        g = H.windows(h, k).tolist()
        t = [tuple(words[i : i + k]) for i in range(len(words) - k + 1)]
        assert len(g) == len(t) and len(set(zip(g, t))) == len(set(t)) == len(set(g))


def test_sliding_minimum_and_anchor_guarantee():
    x = np.random.default_rng(0).integers(0, 100, 200).astype(np.uint64)
    assert S.sliding_min(x, 7).tolist() == [x[i : i + 7].min() for i in range(194)]
    r = random.Random(3)
    v = [f"w{i}" for i in range(60)]
    span = [r.choice(v) for _ in range(30)]
    docs = [" ".join([r.choice(v) for _ in range(r.randrange(40))] + span + [r.choice(v) for _ in range(r.randrange(40))]) for _ in range(20)]
    h, off = H.hash_words(docs, "token")
    g, doc, pos = S.anchors(h, off, 15, 16)
    sets = [set(g[doc == i].tolist()) for i in range(20)]
    assert set.intersection(*sets)
    assert all(0 <= p <= off[d + 1] - off[d] - 15 for d, p in zip(doc, pos))


def test_signatures_estimate_similarity():
    r = np.random.default_rng(5)
    probes, _ = N._plan(128, 5, 32)
    for share in (0.3, 0.6, 0.9):
        common, a, b = (np.unique(r.integers(0, 2**63, n).astype(np.uint64) * np.uint64(2)) for n in (int(2000 * share), int(1000 * (1 - share)), int(1000 * (1 - share))))
        x, y = np.sort(np.concatenate([common, a])), np.sort(np.concatenate([common, b]))
        true = len(np.intersect1d(x, y)) / len(np.union1d(x, y))
        s = N.one_permutation(np.concatenate([x, y]), np.array([0, len(x), len(x) + len(y)]), 128, probes)
        assert abs((s[0] == s[1]).mean() - true) < 0.15
    s = N.one_permutation(np.array([5, 9], np.uint64), np.array([0, 1, 2]), 128, probes)
    assert s.shape == (2, 128) and (s != np.iinfo(np.uint64).max).all()


@settings(max_examples=120, deadline=None)
@given(st.text(alphabet="ab .\n;(1)", min_size=0, max_size=400), st.integers(20, 60), st.integers(0, 15))
def test_pieces_round_trip(text, limit, overlap):
    ends = splitting.cut(text, limit, overlap)
    starts = [0] + [e - overlap for e in ends[:-1]]
    pieces = [text[s:e] for s, e in zip(starts, ends)]
    assert ends[-1] == len(text) and all(len(p) <= limit for p in pieces) and all(a < b for a, b in zip(ends, ends[1:]))
    assert pieces[0] + "".join(p[overlap:] for p in pieces[1:]) == text
    assert len(ends) == 1 or len(text) > limit


def test_cuts_are_the_best_of_all():
    text = "One two three. Four five six.\n\nSeven eight nine ten. Eleven twelve."
    limit, overlap = 40, 5
    places, pen = splitting.boundaries(text, (limit - overlap) // 4)
    even = len(text) / -(-(len(text) - overlap) // (limit - overlap))

    def cost(i, used):  # all ways, recursively
        if i == len(places) - 1:
            return 0.0
        out = float("inf")
        for j in range(i + 1, len(places)):
            start = places[i] if i >= 0 else 0
            if places[j] - start + (overlap if i >= 0 else 0) > limit:
                break
            out = min(out, pen[j] + 1 + ((places[j] - start - even) / (limit - overlap)) ** 2 + cost(j, used + 1))
        return out

    ends = splitting.cut(text, limit, overlap)
    at = [list(places).index(e) for e in ends]
    mine = sum(pen[j] + 1 + ((places[j] - (places[i] if i >= 0 else 0) - even) / (limit - overlap)) ** 2 for i, j in zip([-1] + at, at))
    assert abs(mine - cost(-1, 0)) < 1e-9


def test_sainte_lague_against_one_seat_at_a_time():
    r = random.Random(4)
    for _ in range(60):
        w = [r.random() for _ in range(r.randint(1, 8))]
        most = [r.randrange(0, 40) for _ in w]
        seats = r.randrange(0, 120)
        want = [0] * len(w)
        for _ in range(seats):
            free = [i for i in range(len(w)) if want[i] < most[i]]
            if not free:
                break
            i = max(free, key=lambda i: (w[i] / (2 * want[i] + 1), -i))
            want[i] += 1
        got = mixing.sainte_lague(w, seats, most)
        assert sum(got) == sum(want) and all(g <= m for g, m in zip(got, most))
        assert got == want
    much = mixing.sainte_lague([0.4, 0.3, 0.3], 10**12, [10**11, 10**12, 10**12])  # a capped source, no step a seat
    assert much == [10**11, 45 * 10**10, 45 * 10**10]
    assert mixing.sainte_lague([], 5) == [] and mixing.sainte_lague([0.0], 5) == [0]


def test_discounts_and_model():
    assert np.allclose(repetition.discounts(10, 4, 2, 1), [1 - 2 * (10 / 18) * 0.4, 2 - 3 * (10 / 18) * 0.5, 3 - 4 * (10 / 18) * 0.5])
    h, _ = H.hash_words(["a b a c a b d"])
    from collections import Counter

    c = Counter(zip(h[:-1].tolist(), h[1:].tolist()))
    a, b = (np.array([k[i] for k in c], np.uint64) for i in (0, 1))
    m = repetition.Model(np.array([0.5, 1, 1.5]), a, b, np.array(list(c.values())), np.array([0.5, 0.9, 1.2]))
    v = np.arange(m.size)
    for x in range(m.size):
        assert abs(m.lower(np.full(m.size, x), v).sum() - 1) < 1e-9


def test_pair_blocks():
    import pandas as pd

    f = pd.DataFrame({"xs": [[1, 2, 3], [1, 2]], "ys": [[1, 2, 3], [7]], "same": [True, False]})
    out = next(cooccurrence._pair_blocks([f]))
    got = {(int(c) >> 32, int(c) & 0xFFFFFFFF): int(n) for c, n in zip(out["code"], out["n"])}
    assert got == {(1, 2): 1, (1, 3): 1, (2, 3): 1, (1, 7): 1, (2, 7): 1}


def lexicon():
    words = dict.fromkeys("declaration border competent pending within under cross the rule plant committee".split(), 5000)
    return noise.Lexicon(words, {"cross-border": 300}, {"No C #/# Gazette of the Land #. #. #"})


def test_glyph_edits():
    lex = lexicon()
    assert [lex.misread(w) for w in ("dedaration", "b0rder", "compefenf", "pendmg", "wìthin", "iinder", "border", "zzzz", "e471", "12")] == ["declaration", "border", "competent", "pending", "within", "under", None, None, None, None]
    assert lex.links("border") == [] and lex.links("b0rder", 4999) == ["border"] and lex.links("b0rder", 5000) == []


def test_vectors_tell_contexts_apart():
    m = np.zeros((40, 40))
    m[:20, 20:30] = m[20:30, :20] = 9
    m[:10, 30:] = m[30:, :10] = 9
    v = noise._vectors(m, 8)
    assert v[25] @ v[26] > 0.9 > 0.5 > v[25] @ v[35]


def test_noise_kinds_and_repair():
    lex = lexicon()

    def ex(t):
        kinds, text = noise.tidy(t, lex)
        wrong = {w: lex.misread(w) for w in noise.suspects(text, lex, set())}
        return kinds | ({"misread"} if wrong else set()), noise.corrected(text, wrong)

    assert ex("the cross-\nborder plant") == (set(), "the cross-border plant")
    assert ex("the com-\nmittee rule") == ({"hyphenation"}, "the committee rule")
    assert ex("the com¬ \r\nmittee rule")[0] == {"hyphenation"}
    assert ex("the com-\n- 43 -\nNo C 3/4  Gazette of the Land  1. 2. 1990\nmittee rule") == ({"hyphenation", "page_number", "header"}, "the committee rule")
    assert ex("the rule\nPage 4 of 8\nplant.")[0] == {"page_number"} and ex("the rule\n[18]\nplant.")[0] == {"page_number"}
    assert ex("codes:\n1234\n5678\n9012\n12 plant")[0] == set()
    assert ex("The B0rder within")[1] == "The Border within" and ex("mere\nline breaks")[0] == set()
    assert ex("") == (set(), "") and ex(" \n\n ")[0] == set()
    long = "x" * 200_000
    assert ex(long)[1] == long


def test_misspelt_codes_stay():
    lex = lexicon()
    assert noise.suspects("E471 CO2 PM10 20a " + string.ascii_uppercase * 3, lex, set()) == set()
