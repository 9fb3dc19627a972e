"""The operators against brute force, on rows with nulls, empty and long texts, ties, repeats and clashing columns."""

import hashlib
import random
import zlib

import numpy as np
import pytest
import xxhash

from terravane.llm import bfd_packing, components, cover_tree, language_id, media, mixture_packing, piece_viterbi, simhash, suffix_dedup, token_counts, tokens, toxicity

ODD = "doc_id long, text string, lang string, source string, n_chars long, task int, ids string, bits long, part int, a string"


def _rows(seed=0, n=60):
    r = random.Random(seed)
    words = ["Alpha", "beta.", "gamma,", "don't", "Élan", "straße", "x1!", "日本", "the", "of"]
    passages = [" ".join(r.choice(words) for _ in range(14)) for _ in range(4)]
    rows = []
    for i in range(n):
        text = " ".join(r.choice(passages) if r.random() < 0.3 else r.choice(words) for _ in range(r.randint(0, 40)))
        rows.append((i * 7 % n, text, "en", f"s{i % 3}" if i % 10 else None, len(text), 1, "x", 5, 2, "a"))
    rows += [(None, passages[0], None, None, None, None, None, None, None, None), (n + 1, None, "en", "s0", 0, 1, "", 0, 0, ""), (n + 2, "", "de", "s1", 0, 1, "", 0, 0, ""), (n + 3, "wort " * 9000, "de", "s1", 0, 1, "", 0, 0, ""), (n + 4, "\u0000 \t\n…!", "de", "s1", 0, 1, "", 0, 0, "")]
    return rows + rows[:5]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(_rows(), ODD).repartition(3).cache()


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], ODD)


@pytest.fixture(scope="module")
def ids_of():
    library = tokens.WordEncoder(tokens.vocabulary()).library
    return lambda text: [*library.encode(text or "", add_special_tokens=False).ids, 2]


def test_words_encode_as_the_library_does():
    e = tokens.WordEncoder(tokens.vocabulary())
    r = random.Random(1)
    odd = ["", "Don't they're I'LL 's", "ΟΔΟΣ", "İstanbul", "<|endoftext|>x <|ENDOFTEXT|>", "a\x1cb\x85c\xa0d", "KÅÅ", "ß.ẞ,", "...a..b,.", "日本", "x" * 3000, "a_b", "wow!!!'s"]
    odd += ["".join(r.choice("aAé É.,'sStT!<|>\nßİΣ1½_") for _ in range(r.randint(0, 30))) for _ in range(500)]
    assert e.encode([x.encode() for x in odd]) == e._by_library(odd)


def test_mixture_packing(docs, ids_of):
    out = mixture_packing.pack_by_mixture(docs, window=64).collect()
    by_doc, by_window = {}, {}
    for r in out:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_window.setdefault(r.sequence_id, []).append((r.offset, r.length))
    total = 0
    for doc_id in {x[0] for x in _rows()}:
        texts = [x[1] for x in _rows() if x[0] == doc_id]
        ids = ids_of(texts[0])
        pieces = sorted((r.start, r.length, r.ids_crc32, r.doc_tokens) for r in by_doc[doc_id])
        assert sum(p[1] for p in pieces) == len(ids) * len(texts)
        total += len(ids) * len(texts)
        assert all(p[3] == len(ids) and p[2] == zlib.crc32(np.array(ids[p[0] : p[0] + p[1]], "<u4").tobytes()) for p in pieces)
    assert sorted(by_window) == list(range(-(-total // 64)))
    for k, parts in by_window.items():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at == (64 if k < max(by_window) else total - 64 * max(by_window))


def _round_robin(totals, quanta, packets):
    """Deficit round-robin, literally: (queue, first token, tokens) of every visit that takes any."""
    left, deficit, out = list(totals), [0] * len(totals), []
    while any(left):
        for q in range(len(totals)):
            if not left[q]:
                continue
            deficit[q] += quanta[q]
            taken = min(left[q], (deficit[q] >> 16) // packets[q] * packets[q])
            if taken:
                out.append((q, totals[q] - left[q], taken))
                deficit[q] -= taken << 16
                left[q] -= taken
    return out


@pytest.mark.parametrize(("totals", "shares", "packets"), [([5000, 300, 7], [50, 25, 25], [1, 1, 1]), ([900, 900, 900], [99.3, 0.5, 0.2], [1, 1, 1]), ([700, 3000], [1.7, 60.1], [256, 1]), ([1], [64], [1]), ([40, 0, 3], [10, 10, 44], [1, 1, 1])])
def test_schedule_is_deficit_round_robin(totals, shares, packets):
    quanta = [max(1, int(x * 65536)) for x in shares]
    s = mixture_packing.Schedule(totals, quanta, packets)
    at, expected = 0, []
    for q, first, n in _round_robin(totals, quanta, packets):
        expected += [(q, first + i, at + i) for i in range(n)]
        at += n
    got = []
    for q, n in enumerate(totals):
        if n:
            first = np.arange(0, n, 13)
            _, begin, length, place = s.stretches(q, first, np.minimum(13, n - first))
            got += [(q, b + i, p + i) for b, m, p in zip(begin.tolist(), length.tolist(), place.tolist(), strict=True) for i in range(m)]
    assert sorted(got) == sorted(expected)


def test_windows_hold_the_target_shares():
    s = mixture_packing.Schedule([60_000, 30_000, 10_000], [mixture_packing.quantum(w, 10, 4096) for w in (6, 3, 1)])
    for q, share in enumerate((0.6, 0.3, 0.1)):
        n = int(s.n[q])
        parts = s.stretches(q, np.array([0]), np.array([n]))
        _, _, length, number, _ = mixture_packing._cut_into_windows(*parts, 4096)
        per_window = np.bincount(number, length)[:-1]
        assert abs(per_window - share * 4096).max() <= 3


def _pieces(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_packing_does_not_depend_on_the_layout(docs):
    one = _pieces(mixture_packing.pack_by_mixture(docs.repartition(1), window=64))
    best = _pieces(bfd_packing.pack_best_fit(docs.repartition(1), width=64))
    for n in (3, 16):
        assert _pieces(mixture_packing.pack_by_mixture(docs.repartition(n), window=64)) == one
        assert _pieces(bfd_packing.pack_best_fit(docs.repartition(n), width=64)) == best


def test_many_weighted_sources(spark, ids_of):
    """1100 sources, each owed too little of a window for a queue of its own, take turns; a large one has its queue."""
    r, turn, window = random.Random(7), mixture_packing.TURN, 4096
    rows = [(i, f"s{i % 1100:04}", " ".join(r.choice(["alpha", "beta", "gamma"]) for _ in range(r.randint(1, 700)))) for i in range(2200)]
    rows += [(5000 + i, "big", "delta " * 5000) for i in range(40)]
    weights = {"big": 3000.0} | {f"s{i:04}": 1.0 + i % 3 for i in range(1100)}
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    out = mixture_packing.pack_by_mixture(df, weights=weights, window=window).collect()
    total = {}
    for i, source, text in rows:
        total[source] = total.get(source, 0) + len(ids_of(text))
    units = {k: max(1, round(w / 3000.0 * mixture_packing.WEIGHT_UNITS)) for k, w in weights.items()}
    everything, tail = sum(units.values()), sorted(k for k in units if k != "big")
    quanta = [mixture_packing.quantum(units["big"], everything, window), mixture_packing.quantum(sum(units[k] for k in tail), everything, window)]
    turns = sorted(((j + 1) * turn / units[k], k, j) for k in tail for j in range(-(-total[k] // turn)))
    order = [(k, j * turn + i) for _, k, j in turns for i in range(min(turn, total[k] - j * turn))]
    place, at = {}, 0
    for q, first, n in _round_robin([total["big"], len(order)], quanta, [1, 1]):
        for i in range(n):
            place[("big", first + i) if q == 0 else order[first + i]] = at + i
        at += n
    assert sorted(r["sequence_id"] * window + r["offset"] + i for r in out for i in range(r["length"])) == list(range(at))
    by_source = {}
    for r in out:
        source = "big" if r.doc_id >= 5000 else f"s{r.doc_id % 1100:04}"
        by_source.setdefault(source, []).extend(r["sequence_id"] * window + r["offset"] + i for i in range(r["length"]))
    for source, got in by_source.items():
        assert sorted(got) == sorted(v for (k, _), v in place.items() if k == source) if source in ("big", "s0000", "s0517", "s1099") else len(got) == total[source]
    early = [r for r in out if r.sequence_id < 0.9 * total["big"] * everything / units["big"] // window]  # as long as it lasts
    assert abs(sum(r["length"] for r in early if r.doc_id >= 5000) / sum(r["length"] for r in early) - units["big"] / everything) < 0.01


def test_mixture_by_weights(docs):
    out = mixture_packing.pack_by_mixture(docs, weights={"s0": 3.0, "s1": 1.0}, window=64).groupBy("queue").sum("length").collect()
    assert len(out) == 4
    with pytest.raises(ValueError):
        mixture_packing.pack_by_mixture(docs, weights={"s0": 0.0})


def test_empty_tables(nothing):
    assert mixture_packing.pack_by_mixture(nothing).count() == 0
    assert bfd_packing.pack_best_fit(nothing).count() == 0
    assert simhash.near_duplicates(nothing).count() == 0
    assert suffix_dedup.remove_repeats(nothing).count() == 0
    assert media.to_transport_streams(nothing).count() == 0
    assert piece_viterbi.encode(nothing).count() == 0
    assert token_counts.count_by_line(nothing).count() == 0
    assert language_id.fit(nothing) is None and language_id.identify(nothing, None).count() == 0
    assert toxicity.fit(nothing, nothing.selectExpr("doc_id", "0 as toxic")) is None and toxicity.score(nothing, None).count() == 0


def test_best_fit_packing(docs, ids_of):
    out = bfd_packing.pack_best_fit(docs, width=256).collect()
    got = {}
    for r in out:
        row = np.frombuffer(r.input_ids, "<u2")
        assert len(row) == 256 and r.cu_seqlens[0] == 0 and r.position_resets == r.cu_seqlens[:-1] and r.cu_seqlens[-1] == r.n_tokens
        assert (row[r.n_tokens :] == 0).all()
        for a, b, d, s in zip(r.cu_seqlens, r.cu_seqlens[1:], r.doc_ids, r.doc_starts, strict=False):
            got.setdefault(d, []).append((s, row[a:b].tolist()))
        assert (bfd_packing.positions(r.cu_seqlens, 256)[r.position_resets] == 0).all()
    assert len({r.sequence_id for r in out}) == len(out)
    for doc_id in {x[0] for x in _rows()}:
        texts = [x[1] for x in _rows() if x[0] == doc_id]
        ids = ids_of(texts[0])
        assert sorted(got[doc_id]) == sorted((s, ids[s : s + 256]) for s in range(0, len(ids), 256) for _ in texts)


def test_best_fit_is_best():
    r = random.Random(0)
    lengths = [r.randint(1, 100) for _ in range(500)]
    free = []
    for n in sorted(lengths, reverse=True):
        fit = min((f for f in free if f >= n), default=None)
        if fit is not None:
            free.remove(fit)
        free.append((100 if fit is None else fit) - n)
    assert sorted(100 - f for f in free) == sorted(sum(lengths[i] for i in s) for s in bfd_packing.best_fit(lengths, 100))


def test_cover_tree(spark):
    r = np.random.default_rng(0)
    x = np.concatenate([np.repeat(r.normal(size=(5, 6)), 60, axis=0) + r.normal(size=(300, 6)) * 0.01, r.normal(size=(300, 6)), np.zeros((100, 6))])
    rows = [(int(i), [float(v) for v in x[i]], "c") for i in range(len(x))]
    rows += [(1000, None, ""), (1001, [1.0, None, 0.0, 0.0, 0.0, 0.0], ""), (1002, [float("nan")] * 6, ""), (None, [1.0] * 6, ""), (1020, [1.0, 2.0], ""), (1021, [3.0, 4.0], ""), (1040, [], ""), rows[3]]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, cell string").repartition(3)
    from pyspark.sql import functions as F

    got = sorted((v.query_id, v["rank"], v.vec_id, v.score) for v in cover_tree.top_k(df, F.col("vec_id") % 20 == 0, k=7).collect())
    q = np.floor(64 * x)
    want = []
    for i in range(0, len(x), 20):
        s = q @ q[i]
        order = [j for j in np.lexsort((np.arange(len(x)), -s)) if j != i][:7]
        want += [(i, k + 1, int(j), int(s[j])) for k, j in enumerate(order)]
    assert got == sorted([*want, (1020, 1, 1021, 192 * 64 + 256 * 128)])
    assert cover_tree.top_k(df.where("false"), F.lit(True)).count() == 0


@pytest.mark.parametrize("size", [1e3, 1e5, 3e7, 1e9])
def test_large_and_negative_products_keep_their_ties(spark, size):
    from pyspark.sql import functions as F

    r = random.Random(int(size))
    rows = [(20, [size, 0.0, size])] + [(i, [-size, float(r.randint(-3, 3)), -size]) for i in (9, 3, 7, 5)] + [(30 + i, [float(r.choice([-1, 1])) * size, size, -size + r.randint(0, 1)]) for i in range(60) if i != 10]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = [(v["rank"], v.vec_id, v.score) for v in cover_tree.top_k(df, F.col("vec_id") == 20, k=64, scale=1.0).orderBy("rank").collect()]
    q = [int(x) for x in rows[0][1]]
    scores = sorted((-sum(int(a) * b for a, b in zip(v, q, strict=True)), i) for i, v in rows[1:])
    assert got == [(k + 1, i, -s) for k, (s, i) in enumerate(scores[:64])]


def test_products_beyond_whole_numbers(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(1, [1e12]), (2, [1e12])], "vec_id long, embedding array<double>")
    with pytest.raises(OverflowError):
        cover_tree.top_k(df, F.lit(True), scale=1.0)


def test_cover_tree_prunes():
    x = np.repeat(np.random.default_rng(1).normal(size=(8, 16)) * 50, 1000, axis=0) + np.random.default_rng(2).normal(size=(8000, 16))
    ids = np.arange(8000)
    data, queries = cover_tree.CoverTree(x, ids), cover_tree.CoverTree(x[::20], ids[::20], 64)
    pairs = sum(not n[3] for n in data.nodes) * sum(not n[3] for n in queries.nodes)
    assert cover_tree.search(queries, data, cover_tree.BestK(queries, 10)) < 0.6 * pairs


def _languages(spark):
    r = random.Random(3)
    sounds = {"aa": ["ka", "lo", "mi"], "bb": ["sch", "ei", "unt"], "cc": ["eau", "ou", "ré"]}
    rows = []
    for i in range(300):
        lang = sorted(sounds)[i % 3]
        rows.append((i, " ".join("".join(r.choice(sounds[lang]) for _ in range(r.randint(1, 4))) for _ in range(r.randint(3, 30))), lang))
    return spark.createDataFrame([*rows, (900, None, "aa"), (901, "123 ...", "bb"), (902, "", None), (903, "ka" * 30000, None)], "doc_id long, text string, lang string")


def test_language_id(spark):
    docs = _languages(spark)
    model = language_id.fit(docs.where("doc_id % 4 != 2"))
    found = {r.doc_id: r for r in language_id.identify(docs, model).collect()}
    held = [r for r in docs.where("doc_id % 4 = 2 and doc_id < 900").collect()]
    assert np.mean([found[r.doc_id].lang_pred == r.lang for r in held]) > 0.95
    assert [found[i].lang_pred for i in (900, 901, 902, 903)] == ["und", "und", "und", "aa"]
    assert all(0 <= r.score <= 1 for r in found.values())
    assert {r.doc_id for r in language_id.keep(docs, model, 0.0).collect()} == set(found) - {900, 901, 902}


def test_all_languages_are_learned(spark, monkeypatch):
    r = random.Random(6)
    rows = []
    for i in range(70):
        words = ["".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(7)) for _ in range(12)]
        rows += [(i * 10 + k, " ".join(r.choice(words) for _ in range(20)), f"l{i:02}") for k in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.fit(docs)
    assert model.languages == [f"l{i:02}" for i in range(70)]
    found = {x.doc_id: (x.lang_pred, x.score) for x in language_id.identify(docs, model).collect()}
    assert all(found[i][0] == lang for i, _, lang in rows)
    monkeypatch.setattr(language_id, "LANGUAGES_AT_ONCE", 100)
    assert found == {x.doc_id: (x.lang_pred, x.score) for x in language_id.identify(docs, language_id.fit(docs)).collect()}


@pytest.mark.parametrize("order", [4, 5])
def test_pieces_count_what_whole_words_do(order):
    r = random.Random(order)
    for n in (9, 63, 64, 65, 66, 123, 124, 125, 1000):
        word = bytes(r.choice(b"abcd\xe6\x97") for _ in range(n))
        _, whole, depth = language_id.keys_of([word], order)
        _, keys, deep = language_id.keys_of_pieces(language_id.pieces_of(word, order), order)
        assert all(np.array_equal(np.sort(a), np.sort(b)) for a, b in zip(whole, keys, strict=True))
        assert np.array_equal(np.sort(np.minimum(depth, order)), np.sort(np.minimum(deep, order)))


def test_runs_without_spaces_are_learned_whole(spark):
    """Languages, and toxic expressions, that differ only far from a run's start."""
    r = random.Random(4)
    same = "日本語文" * 8
    text = lambda a: same + "".join(r.choice(a) for _ in range(60))
    rows = [(i, text("春夏秋冬" if i % 2 else "東西南北"), "xx" if i % 2 else "yy") for i in range(80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.fit(docs.where("doc_id < 60"))
    found = {x.doc_id: x.lang_pred for x in language_id.identify(docs, model).collect()}
    assert all(found[i] == lang for i, _, lang in rows)
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, toxic int")
    toxic = {x.doc_id: x.predicted for x in toxicity.score(docs, toxicity.fit(docs, labels)).collect()}
    assert all(toxic[i] == i % 2 for i in range(80))


def test_code_lengths_are_exact():
    """Every byte's code in every state sums to at most one, and a word's bits are those of a plain walk up the tree."""
    words, counts = [b"abab", b"abc", b"b"], np.array([[3, 0], [1, 2], [0, 5]])
    model = language_id.ContextTrees(words, counts, ["x", "y"], order=2)

    def plain(word, lang):
        coded, out = b" " + word + b" ", 0.0
        for i in range(1, len(coded)):
            for k in range(2, -1, -1):
                if k > i:
                    continue
                context = coded[i - k : i]
                seen = {}
                for w, c in zip(words, counts[:, lang], strict=True):
                    t = b" " + w + b" "
                    for j in range(max(1, k), len(t)):
                        if c and t[j - k : j] == context:
                            seen[t[j]] = seen.get(t[j], 0) + c
                total, kinds = sum(seen.values()), len(seen)
                if coded[i] in seen:
                    out += np.log2((total + kinds) / seen[coded[i]])
                    break
                out += np.log2((total + kinds) / kinds) if kinds else 0
            else:
                out += np.log2(257)
        return out

    tests = [b"abab", b"zz", b"abcb", b"bbbbb", b""]
    assert np.allclose(model.cost(tests), [[plain(w, lang) for lang in (0, 1)] for w in tests], atol=1e-3)


def test_toxicity(spark):
    r = random.Random(5)
    plain, bad = ["lorem", "ipsum", "dolor", "sit", "amet", "elit"], ["snarf", "snarfing", "glurk"]
    rows, labels = [], []
    for i in range(400):
        toxic = i % 5 == 1
        words = [r.choice(plain) + r.choice(["", "a", "us"]) for _ in range(r.randint(5, 60))]
        if toxic:
            for _ in range(3):
                words[r.randrange(len(words))] = r.choice(bad)
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic) if i % 7 else None))
    docs = spark.createDataFrame([*rows, (900, None), (901, ""), (902, "lorem " * 20000), (903, "snarf")], "doc_id long, text string")
    model = toxicity.fit(docs, spark.createDataFrame([*labels, (None, 1), (5000, 1)], "doc_id long, toxic int").where("doc_id % 3 != 0 or doc_id is null"))
    found = {x.doc_id: x for x in toxicity.score(docs, model).collect()}
    held = [i for i in range(0, 400, 3)]
    assert np.mean([found[i].predicted == (i % 5 == 1) for i in held]) > 0.95
    assert found[900].score == found[901].score and found[902].predicted == 0 and all(0 <= x.score <= 1 for x in found.values())
    assert {x.doc_id for x in toxicity.keep(docs, model).collect()} == {k for k, x in found.items() if not x.predicted}


def test_kneser_ney_is_exact():
    """Likelihoods are those of the definition, counted and smoothed by plain loops."""
    words, counts, order = [b"abab", b"abc", b"b", b"cab"], np.array([[3, 0], [1, 2], [0, 5], [2, 2]]), 3
    model = toxicity.ToxicityModels(words, counts, order=order)
    coded = [b" " + w + b" " for w in words]
    grams = {t[j - k : j + 1] for t in coded for j in range(1, len(t)) for k in range(0, min(j, order) + 1)}

    def longest(c):
        out = {}
        for t, n in zip(coded, counts[:, c].tolist(), strict=True):
            for j in range(1, len(t)):
                g = t[j - min(j, order) : j + 1]
                out[g] = out.get(g, 0) + n
        return out

    def chance(context, byte, c, k):
        """Of a byte after its last k bytes of context, by the tables of order k and below."""
        lower = chance(context, byte, c, k - 1) if k else 1 / 257
        if k < order:  # bytes that stand before each gram of k bytes and one
            seen = {g: len({h[:1] for h in grams if len(h) == k + 2 and h[1:] == g}) for g in grams if len(g) == k + 1}
            seen = {g: n for g, n in seen.items() if n}
            here = context[len(context) - k :] if len(context) > k else None
        else:
            seen, here = longest(c), context[max(0, len(context) - order) :]
        if here is None:
            return lower
        own = {g: n for g, n in seen.items() if g[:-1] == here}
        total = sum(own.values())
        if not total:
            return lower
        n = own.get(here + byte, 0)
        return max(n - toxicity.DISCOUNT * min(n, 1), 0) / total + toxicity.DISCOUNT * sum(x > 0 for x in own.values()) / total * lower

    for word in [b"abab", b"zz", b"abcb", b"ccc", b"b", b"cabab"]:
        t = b" " + word + b" "
        expected = sum(np.log(chance(t[:j], t[j : j + 1], 1, order)) - np.log(chance(t[:j], t[j : j + 1], 0, order)) for j in range(1, len(t)))
        assert np.isclose(model.difference([word])[0, 0], expected, atol=1e-4), word


def test_labels_that_repeat_or_contradict(spark):
    docs = spark.createDataFrame([(i, f"{'snarf' if i % 2 else 'lorem'} w{i % 7} x{i % 5}") for i in range(60)], "doc_id long, text string")
    labels = [(i, i % 2) for i in range(60)]
    plain = toxicity.fit(docs, spark.createDataFrame(labels[:-2], "doc_id long, toxic int"))
    other = toxicity.fit(docs, spark.createDataFrame([*labels, *labels[:20], (58, 1), (59, 0), (58, 0)], "doc_id long, toxic int"))
    words = [b"snarf", b"lorem", b"w3", b"zz"]
    assert np.allclose(plain.difference(words), other.difference(words))


def test_classifiers_take_clashing_columns_and_repeats(spark):
    docs = _languages(spark)
    wide = docs.union(docs).selectExpr("doc_id", "text", "lang", "1 as score", "'x' as lang_pred", "2 as predicted", "3 as language", "4 as gram", "5 as n")
    model = language_id.fit(docs)
    plain = {r.doc_id: (r.lang_pred, r.score) for r in language_id.identify(docs, model).collect()}
    out = language_id.identify(wide, language_id.fit(wide)).collect()
    assert len(out) == 2 * len(plain) and all(plain[r.doc_id][0] == r.lang_pred for r in out)
    labels = docs.selectExpr("doc_id", "cast(lang = 'bb' as int) as toxic", "7 as curve", "8 as hash")
    found = toxicity.score(wide, toxicity.fit(docs, labels)).collect()
    assert len(found) == 2 * len(plain) and {(r.doc_id, r.score) for r in found} == {(r.doc_id, r.score) for r in toxicity.score(docs, toxicity.fit(docs, labels)).collect()}


def test_pieces_take_the_best_path():
    model = piece_viterbi.PieceModel(piece_viterbi.vocabulary())
    score = {w: v for w, v in ((k, model.automaton.get(k)[1]) for k in model.automaton.keys())}

    def best(text):
        at = {0: 0.0}
        for e in range(1, len(text) + 1):
            options = [at[s] + score[text[s:e]] for s in range(max(0, e - 20), e) if text[s:e] in score]
            if text[e - 1] not in model.single:
                options.append(at[e - 1] + model.penalty)
            at[e] = max(options)
        return at[len(text)]

    for text in ["the quick  brown fox.", "Straße, naïve!\n\tx", "zzzzqq 日本 \U0001f600", "a" * 200, "", " ", "n't they'll..."]:
        ids = np.frombuffer(model.encode(text), model.dtype).tolist()
        own = piece_viterbi.SPACE + text.replace(" ", piece_viterbi.SPACE) if text else ""
        pieces = sum(score[model.text[i].decode().replace(" ", piece_viterbi.SPACE)] for i in ids if i not in model.byte_id.values())
        assert np.isclose(pieces + model.penalty * sum(c not in model.single for c in own), best(own), rtol=1e-12)
        assert model.decode(model.encode(text)) == text.encode()


def test_piece_round_trip(docs):
    out = piece_viterbi.encode(docs)
    assert all(r.round_trip and 2 * r.n_tokens == len(r.ids) for r in out.collect())
    back = {(r.doc_id, r.text) for r in piece_viterbi.decode(out).collect()}
    assert back == {(x[0], x[1] or "") for x in _rows()}


def _removed(rows, width):
    first = {}
    order = lambda d: float("inf") if d is None else d
    for d, t in rows:
        b = (t or "").encode()
        for i in range(len(b) - width + 1):
            first[b[i : i + width]] = min(order(d), first.get(b[i : i + width], float("inf")))
    out = []
    for d, t in rows:
        b, gone = (t or "").encode(), set()
        for i in range(len(b) - width + 1):
            if first[b[i : i + width]] < order(d):
                gone.update(range(i, i + width))
        out.append((d, len(b), len(gone), sum(i in gone and i - 1 not in gone for i in range(len(b))), hashlib.sha256(bytes(c for i, c in enumerate(b) if i not in gone)).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("change", [{}, {"HOT_SHARE": 1e-9}, {"SHARD_BYTES": 1500}])
def test_suffix_dedup(docs, monkeypatch, change):
    for k, v in change.items():
        monkeypatch.setattr(suffix_dedup, k, v)
    got = sorted((tuple(r) for r in suffix_dedup.remove_repeats(docs).collect()), key=str)
    assert got == _removed([x[:2] for x in _rows()], 50)


@pytest.mark.parametrize("size", [4 << 20, 900])
def test_shards_merge(monkeypatch, size):
    monkeypatch.setattr(suffix_dedup, "ARRAY_BYTES", size)
    r = random.Random(0)
    strings = sorted({b"".join(r.choice([b"ab", b"ba", b"aaaa", b"\0"]) for _ in range(60))[: r.randint(50, 70)] for _ in range(60)})
    windows, least = np.array([len(s) - 49 for s in strings]), np.array([r.randint(0, 9) for _ in strings])
    want = {}
    for s, n, d in zip(strings, windows, least, strict=True):
        for i in range(n):
            want[s[i : i + 50]] = min(d, want.get(s[i : i + 50], 99))
    assert suffix_dedup.repeated_windows(strings, windows, least, 50)[1].tolist() == [want[s[i : i + 50]] for s, n in zip(strings, windows, strict=True) for i in range(n)]


@pytest.mark.parametrize("bundle", [1, 700, 1 << 18])
def test_arrays_of_whole_anchors(monkeypatch, bundle):
    """Contexts of different anchors need no common array, and what shards are told does not depend on how arrays are cut."""
    monkeypatch.setattr(suffix_dedup, "BUNDLE_BYTES", bundle)
    monkeypatch.setattr(suffix_dedup, "_WINDOWS", 40)
    held, plain = [], suffix_dedup.suffix_array
    monkeypatch.setattr(suffix_dedup, "suffix_array", lambda text, depth: held.append(len(text)) or plain(text, depth))
    r = random.Random(0)
    anchors = [bytes(r.choice(b"xyz") for _ in range(20)) for _ in range(12)]
    sent, blobs, by_anchor = [], [], {}
    for shard in range(3):
        own = set()
        while len(own) < 60:
            k, before = r.randrange(12), r.randint(15, 25)
            text = (b"ab" * 15)[-before:] + anchors[k] + r.choice([b"ab", b"ba"]) * 8 + bytes(r.choice(b"ab") for _ in range(r.randint(0, 3)))
            if len(text) >= 50:
                own.add((k, text, before))
        own = [(*x, r.randint(0, 9)) for x in sorted(own)]
        keys = np.array([k for k, *_ in own], np.uint64)
        blobs.append((shard, suffix_dedup._pack(np.arange(60), np.diff(keys, prepend=np.uint64(0)), np.array([len(t) - 49 for _, t, *_ in own], "<u4"), np.array([d for *_, d in own]), np.array([b for *_, b, _ in own], "<u4")), suffix_dedup._press(b"".join(t for _, t, *_ in own))))
        sent.append(own)
        for k, text, *_ in own:
            by_anchor.setdefault(k, set()).add(text)
    first = {}
    for own in sent:
        for _, text, _, d in own:
            for i in range(len(text) - 49):
                first[text[i : i + 50]] = min(d, first.get(text[i : i + 50], 99))
    want = {(shard, e, i) for shard, own in enumerate(sent) for e, (_, text, _, d) in enumerate(own) for i in range(len(text) - 49) if first[text[i : i + 50]] < d}
    got = set()
    for batch in suffix_dedup._one_part(blobs, 50):
        for shard, told in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            got |= {(shard, e, s + i) for e, s, n in zip(*(x.tolist() for x in suffix_dedup._unpack(told)), strict=True) for i in range(n)}
    assert got == want and len(want) > 20
    most = max(sum(map(len, texts)) for texts in by_anchor.values())
    assert held and max(held) <= bundle + most


def test_suffix_array_and_prefixes():
    text = np.frombuffer(b"abracadabra abracadabra\0ab" * 3, np.uint8)
    order, rank = suffix_dedup.suffix_array(text, 64)
    raw = text.tobytes()
    assert [raw[i : i + 64] for i in order] == sorted(raw[i : i + 64] for i in range(len(raw)))
    shared = suffix_dedup.common_prefixes(text, order, rank, np.array([0, 30]), np.array([30, len(raw) - 30]), 50)
    for k in range(1, len(order)):
        a, b = raw[order[k - 1] :], raw[order[k] :]
        assert shared[k] == min(50, next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b))))


def test_prefixes_of_suffixes_that_are_alike_beyond_the_depth():
    r = random.Random(0)
    for _ in range(40):
        block = bytes(r.choice(b"ab") for _ in range(r.randint(60, 90)))
        contexts = [block[r.randint(0, 5) :] + bytes(r.choice(b"abc") for _ in range(r.randint(0, 12))) for _ in range(r.randint(2, 7))]
        raw = b"".join(contexts)
        lengths = np.array([len(c) for c in contexts])
        order, rank = suffix_dedup.suffix_array(np.frombuffer(raw, np.uint8), 50)
        shared = suffix_dedup.common_prefixes(np.frombuffer(raw, np.uint8), order, rank, np.cumsum(lengths) - lengths, lengths, 50)
        for k in range(1, len(order)):
            a, b = raw[order[k - 1] :], raw[order[k] :]
            assert shared[k] == min(50, next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b))))


@pytest.mark.parametrize("parts", [1, 4, 9])
def test_suffix_dedup_on_any_layout(spark, sf_dir, parts):
    rows = [(x.doc_id, x.text) for x in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
    assert sorted((tuple(x) for x in suffix_dedup.remove_repeats(df).collect()), key=str) == _removed(rows, 50)


def _fingerprint(text, n):
    words = [w for w in (text or "").encode().lower().replace(b"\t", b" ").replace(b"\n", b" ").split(b" ") if w]
    grams = [b" ".join(words[i : i + n]) for i in range(len(words) - n + 1)] if len(words) > n else [b" ".join(words)] if words else []
    ones = [sum(xxhash.xxh64_intdigest(g, 42) >> b & 1 for g in grams) for b in range(64)]
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(grams))


@pytest.mark.parametrize("hot", [20_000, 1])
def test_simhash(docs, monkeypatch, hot):
    monkeypatch.setattr(simhash, "HOT_HOMES", hot)
    got = {(r.doc_id, r.fingerprint, r.component_id) for r in simhash.near_duplicates(docs, threshold=2).collect()}
    rows = [(x[0], _fingerprint(x[1], 3)) for x in _rows()]
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (rows[i][1] ^ rows[j][1]).bit_count() <= 2:
                a, b = label[i], label[j]
                label = [min(a, b) if x in (a, b) else x for x in label]
    first = {}
    for (d, _), c in zip(rows, label, strict=True):
        if d is not None:
            first[c] = min(d, first.get(c, d))
    assert got == {(d, f"{f:016x}", first.get(c)) for (d, f), c in zip(rows, label, strict=True)}


def test_anchors_miss_nothing():
    r = np.random.default_rng(0)
    x = r.integers(0, 1 << 63, 500).astype(np.uint64) * np.uint64(2)
    y = x ^ (np.uint64(1) << r.integers(0, 64, 500).astype(np.uint64)) ^ (np.uint64(1) << r.integers(0, 64, 500).astype(np.uint64))
    for codes in ((simhash.GOLAY,), (simhash.GOLAY, simhash.HAMMING)):
        anchors = simhash.Anchors(codes, 2)
        near = set(zip(*(v.tolist() for v in anchors.near(x)), strict=True))
        assert all((i, int(h)) in near for i, h in enumerate(anchors.home(y)))


def test_similar_texts_meet(spark):
    r = random.Random(2)
    base = [[f"w{r.randrange(5000)}" for _ in range(200)] for _ in range(30)]
    rows = []
    for i, words in enumerate(base):
        rows.append((i, " ".join(words)))
        near = list(words)
        for _ in range(3):
            near[r.randrange(200)] = "changed"
        rows.append((100 + i, " ".join(near)))
    df = spark.createDataFrame([*rows, (None, rows[0][1]), (500, None), (501, "")], "doc_id long, text string")
    kept = {x.doc_id for x in simhash.keep_one(df).collect()}
    assert set(range(30)) <= kept and sum(100 + i in kept for i in range(30)) <= 1 and 500 in kept and 501 not in kept and None not in kept


def _similar_groups(rows, n=5):
    """The smallest id that links of 0.8 of the shingles reach, by comparing each with each."""
    words = [(text or "").lower().split() for _, text in rows]
    sets = [{tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} for w in words]
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]) and label[i] != label[j]:
                a, b = label[i], label[j]
                label = [min(a, b) if x in (a, b) else x for x in label]
    return {d: rows[c][0] for (d, _), c in zip(rows, label, strict=True)}


@pytest.mark.parametrize("frequent", [500_000, 0])
def test_similar_is_exact(spark, monkeypatch, frequent):
    monkeypatch.setattr(simhash, "FREQUENT", frequent)
    r = random.Random(5)
    rows, boilerplate = [], [f"b{i}" for i in range(30)]
    for _ in range(60):
        words = [f"w{r.randrange(5000)}" for _ in range(r.choice([6, 40, 150, 300]))] + boilerplate * r.randrange(2)
        rows.append((len(rows), " ".join(words)))
        near, at = list(words), r.randrange(len(words))
        for k in range(r.randrange(1, 2 + len(words) // 12)):  # a passage rewritten, or words here and there
            near[(at + k) % len(near) if len(rows) % 4 else r.randrange(len(near))] = f"x{k}"
        rows.append((len(rows), " ".join(near)))
    group = [f"g{i}" for i in range(120)]
    rows += [(len(rows) + i, " ".join([*group, f"end{i}", f"of{i}"])) for i in range(30)]
    rows += [(len(rows) + i, x) for i, x in enumerate(["one two", "one  Two", "one two three", "", " \n", *[" ".join(group[: 90 + i]) for i in range(0, 30, 3)]])]
    expected = _similar_groups(rows)
    assert 30 < len(set(expected.values())) < len(rows) - 30
    got = {x.doc_id: x.component_id for x in simhash.similar(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()}
    assert got == expected


def test_no_similar_pair_is_missed_among_many(spark):
    r = random.Random(8)
    rows = []
    for i in range(80):
        words = [f"w{r.randrange(9000)}" for _ in range(200)]
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join([*words[:179], *(f"x{i}y{k}" for k in range(21))]))]
    rows += [(1000 + i, " ".join(f"w{r.randrange(9000)}" for _ in range(30))) for i in range(1000)]
    expected = _similar_groups(rows[:160])
    assert all(expected[2 * i + 1] == 2 * i for i in range(80))
    got = {x.doc_id: x.component_id for x in simhash.similar(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == expected | {d: d for d, _ in rows[160:]}


def test_similar_takes_empty_tables_and_crowded_keys(spark, nothing, monkeypatch):
    assert simhash.similar(nothing).count() == 0 and simhash.keep_one(nothing).count() == 0
    monkeypatch.setattr(simhash, "KEY_SETS", 7)
    monkeypatch.setattr(simhash._shared, "CROWDED_ROWS", 3)
    r = random.Random(11)
    common = [f"c{i}" for i in range(30)]
    rows = []
    for i in range(40):
        words = common + [f"w{r.randrange(10**6)}" for _ in range(r.choice([3, 5, 60]))]
        rows += [(3 * i, " ".join(words)), (3 * i + 1, " ".join([*words, f"t{i}"])), (3 * i + 2, " ".join(words))]
    got = {x.doc_id: x.component_id for x in simhash.similar(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == _similar_groups(rows)


def test_kept_columns_must_not_clash(docs, nothing):
    with pytest.raises(ValueError):
        suffix_dedup.remove_repeats(docs.withColumn("n_spans", docs["bits"]), keep=("doc_id", "n_spans"))
    assert suffix_dedup.remove_repeats(nothing, keep=("doc_id", "source"), with_text=True).count() == 0


def test_matrices_are_written(docs, tmp_path, spark):
    packed = bfd_packing.pack_best_fit(docs, width=256)
    bfd_packing.write_matrices(packed, f"{tmp_path}/packed")
    back = spark.read.parquet(f"{tmp_path}/packed")
    assert back.count() == packed.count() and all(len(x.input_ids) == 512 for x in back.select("input_ids").collect())


@pytest.mark.parametrize("few", [1_000_000, 3])
def test_components(spark, monkeypatch, few):
    monkeypatch.setattr(components, "FEW_LINKS", few)
    links = [(1, 2), (2, 3), (9, 3), (5, 6), (6, 5), (7, 7), (None, 1), *((i, i + 1) for i in range(20, 60))]
    got = {r.node: r.root for r in components.connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 9: 1, 5: 5, 6: 5, 7: 7} | {i: 20 for i in range(20, 61)}


@pytest.mark.parametrize("rule", token_counts.RULES)
def test_token_counts(docs, rule):
    e = token_counts.SpanEncoder(token_counts.vocabulary())
    out = token_counts.count_by_line(docs, rule=rule).collect()
    assert len(out) == len(_rows())
    for r in out:
        assert np.isclose(sum(r.section_tokens), r.n_tokens) and len(r.section_starts) == r.n_sections
    first, stop = e.spans("ab\n\n\ncd é\U0001f600".encode())
    starts = token_counts.line_starts("ab\n\n\ncd é\U0001f600".encode())
    assert starts.tolist() == [0, 3, 4, 5] and stop[-1] == 10
    counts, _ = token_counts.attribute(first, stop, starts, 10, rule)
    brute = np.zeros(4)
    for a, b in zip(first, stop, strict=True):
        over = np.array([sum(s <= c < t for c in range(a, b)) for s, t in zip(starts, [*starts[1:], 10], strict=True)])
        if rule == "split":
            brute += over / over.sum()
        else:
            brute[over.argmax() if rule == "majority" else over.nonzero()[0][0]] += 1
    assert np.allclose(counts, brute)


def test_token_counts_by_field(spark):
    df = spark.createDataFrame([(1, "hello", "a  b"), (2, None, ""), (3, "", "x")], "k long, t string, u string")
    got = {r.k: (r.t_tokens, r.u_tokens) for r in token_counts.count_by_field(df, "k", ["t", "u"]).collect()}
    assert got[2] == (1.0, 0.0) and sum(got[3]) == 2.0 and got[1][0] == 2.0
    with pytest.raises(ValueError):
        token_counts.count_by_line(df.selectExpr("k as doc_id", "t as text"), rule="other")
    assert token_counts.count_by_field(df.where("false"), "k", ["t"]).count() == 0
    assert token_counts.count_by_field(df.union(df), "k", []).columns == ["k"] and token_counts.count_by_field(df.union(df), "k", ["t"]).count() == 6
    with pytest.raises(ValueError):
        token_counts.count_by_field(df.withColumnRenamed("k", "t_tokens"), "t_tokens", ["t"])


def test_token_spans_by_decoding():
    """Each token's span is that of the characters its bytes touch, found from the tokens' own bytes."""
    e = token_counts.SpanEncoder(token_counts.vocabulary())
    for text in ("plain words, 1234", "é\U0001f600\U0001f44d日本", "a\n\n b\tc  ", "naïve—“quotes”"):
        pieces = [e.encoding.decode_single_token_bytes(t) for t in e.encoding.encode_ordinary(text)]
        character = [k for k, c in enumerate(text) for _ in c.encode()]
        at, expected = 0, []
        for p in pieces:
            expected.append((character[at], character[at + len(p) - 1] + 1))
            at += len(p)
        assert list(zip(*(x.tolist() for x in e.spans(text.encode())), strict=True)) == expected


def test_transport_streams(docs):
    out = media.to_transport_streams(docs, with_media=True)
    rows = out.collect()
    assert len(rows) == len(_rows())
    for r, back in zip(rows, media.read_transport_streams(out).collect(), strict=True):
        payload = media.pad(next(x[1] or "" for x in _rows() if x[0] == r.doc_id).encode())
        assert (r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]))
        assert len(payload) % 576 == 0 and r.media_bytes == len(r.media) and r.media_sha256 == hashlib.sha256(r.media).hexdigest()
        assert bytes(back.payload) == payload and back.counter_errors == 0 and back.timestamps == r.timestamps and r.random_access[0] == 0


def _plain_reading(media):
    """A transport stream read byte by byte: payload, timestamps, clock references, and units that can be joined at."""
    packets = [media[i : i + 188] for i in range(0, len(media), 188)]
    pid = lambda p: (p[1] & 31) << 8 | p[2]
    last, tables, units, clocks, joins = {}, set(), [], [], []
    for p in packets:
        assert p[0] == 0x47 and p[3] & 0xC0 == 0
        assert pid(p) not in last or (last[pid(p)] + 1) % 16 == p[3] & 15
        last[pid(p)] = p[3] & 15
        at, flags = 4, 0
        if p[3] & 0x20:
            flags = p[5] if p[4] else 0
            at = 5 + p[4]
        if pid(p) in (0, 0x1000):
            tables.add(pid(p))
            continue
        if flags & 0x10:
            clocks.append(int.from_bytes(p[6:10], "big") << 1 | p[10] >> 7)
        if p[1] & 0x40:
            if flags & 0x40:
                joins.append((len(units), tables == {0, 0x1000}))
                tables = set()
            units.append(b"")
        units[-1] += p[at:]
    stamps, payload = [], b""
    for u in units:
        assert u[:4] == b"\0\0\1\xbd" and int.from_bytes(u[4:6], "big") == len(u) - 6
        s = int.from_bytes(u[9:14], "big")
        stamps.append((s >> 33 & 7) << 30 | (s >> 17 & 0x7FFF) << 15 | s >> 1 & 0x7FFF)
        payload += u[9 + u[8] :]
    return payload, stamps, clocks, joins


def test_streams_by_an_independent_reader():
    payload = media.pad(bytes(i * 37 % 251 for i in range(300_000)))
    got, stamps, clocks, joins = _plain_reading(media.write_stream(payload))
    stream = media.Stream(media.write_stream(payload))
    assert got == payload == stream.payload and stamps == stream.timestamps and clocks == stream.clock
    assert [k for k, _ in joins] == stream.random_access == list(range(0, stream.units, 8)) and all(sound for _, sound in joins)
    assert all(s - c == media.DELAY for s, c in zip(stamps, clocks, strict=True)) and max(np.diff(clocks)) <= 9000


def test_joining_repeats_and_discontinuities():
    payload = media.pad(bytes(i % 256 for i in range(200_000)))
    whole = media.write_stream(payload)
    packets = [whole[i : i + 188] for i in range(0, len(whole), 188)]
    assert media.Stream(b"".join(packets[:5] + packets[4:5] + packets[5:])).counter_errors == 0  # a repeated packet
    assert media.Stream(b"".join(packets[:5] + packets[4:5] + packets[5:])).payload == payload
    second = [i for i, p in enumerate(packets) if p[1:3] == b"\x40\0"][1]  # the tables before the second point of access
    joined = media.Stream(b"".join(packets[second:]))
    assert joined.payload == payload[8 * media.UNIT :] and joined.random_access[0] == 0
    third = [i for i, p in enumerate(packets) if p[1:3] == b"\x40\0"][2]
    marked = [bytes([*p[:5], p[5] | 0x80, *p[6:]]) if i == third + 2 else p for i, p in enumerate(packets)]
    cut = lambda ps: media.Stream(b"".join(ps[:second] + ps[third:]))
    assert cut(packets).payload == cut(marked).payload == payload[: 8 * media.UNIT] + payload[16 * media.UNIT :]
    assert cut(packets).counter_errors == 3 and cut(marked).counter_errors == 2  # both tables and the stream


@pytest.mark.parametrize("n", [0, 1, 575, 576, 577, 9216, 9217, 200_000])
def test_streams_of_all_sizes(n):
    payload = media.pad(bytes(i * 31 % 256 for i in range(n)))
    stream = media.Stream(media.write_stream(payload))
    assert stream.payload == payload and stream.units == -(-len(payload) // media.UNIT) and stream.counter_errors == 0
    broken = bytearray(media.write_stream(payload))
    broken[188 * 3 + 3] ^= 4
    assert media.Stream(bytes(broken)).counter_errors > 0


def test_broken_streams():
    good = media.write_stream(media.pad(b"x"))
    for bad in (good[:-1], b"\0" + good[1:], good[188:], good[:30] + bytes([good[30] ^ 1]) + good[31:376]):
        with pytest.raises((ValueError, IndexError)):
            media.Stream(bad[:188] + bad[188:])
