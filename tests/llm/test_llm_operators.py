"""Each operator on rows that are odd in every way, and against brute force."""

import base64
import itertools
import json
import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from signalbook.llm import (
    ann,
    components,
    kn_quality,
    lang_id,
    line_rules,
    mixing,
    near_dup,
    packing,
    sharding,
    shingles,
    toxicity,
    warc,
)
from signalbook.llm import queries as q

PROSE = "the cat sat on the mat and looked at the moon over the quiet old town tonight"
LONG = " ".join(f"word{i}" for i in range(40_000))
CLASHES = "shard slot size tie taken target host text_hash node item length lang_pred score part n __x".split()
ROWS = [
    (1, PROSE, "en", "a"),
    (1, PROSE, "en", "a"),  # a repeated row
    (2, PROSE + " indeed", "en", "a"),
    (3, None, "en", "a"),
    (4, "", None, "a"),
    (5, " \n\t ", "en", None),
    (6, "12 34 !!", "en", None),
    (None, "nobody knows which number this text has", None, None),
    (7, LONG, "en", "b"),
    (8, "one two", None, "b"),
    (9, "x" * 300_000, "en", "b"),
    (10, "größe und straße für alle menschen in der stadt am fluss heute", "de", "c"),
]


@pytest.fixture(scope="module")
def odd(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string, lang string, source string")
    df = df.withColumn("n_chars", F.length("text").cast("long"))
    return df.select("*", *[F.lit(f"old {c}").alias(c) for c in CLASHES])


@pytest.fixture(scope="module")
def none(odd):
    return odd.limit(0)


# --- near duplicates -----------------------------------------------------------


def test_near_duplicates_of_odd_rows(odd, none):
    found = {(r.doc_id, r.n_shingles): (r.component_id, r.kept) for r in near_dup.near_duplicates(odd).collect()}
    assert found[1, 13] == (1, True) and found[2, 14] == (1, False)
    assert found[3, 0] == (3, True) and found[5, 0] == (5, True)
    assert found[None, 3] == (None, False)
    assert found[7, 39_996] == (7, True) and found[9, 1] == (9, True)
    assert near_dup.near_duplicates(none).count() == 0
    kept = [r.doc_id for r in near_dup.deduplicated(odd).collect()]
    assert sorted(kept, key=str) == sorted([1, 3, 4, 5, 6, None, 7, 8, 9, 10], key=str)


def test_copies_that_link_in_a_chain(spark):
    base = [f"w{i}" for i in range(60)]
    rows = []
    for k in range(12):  # each differs from the one before by one word
        own = base.copy()
        own[5 * k : 5 * k + 1] = [f"other{k}"]
        base = own
        rows.append((100 + k, " ".join(own)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.component_id for r in near_dup.near_duplicates(df).collect()} == {100}


def test_shingles_are_those_of_the_words():
    texts = ["A b c d e f", "a B c\td\ne F a b c d e f", "b c", "", None, "é É " * 4, "z" * 50]
    sets, at = shingles.shingle_sets(pa.array(texts))
    want = []
    for t in texts:
        w = (t or "").encode().lower().split()
        want.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    got = [set(sets[at[i] : at[i + 1]].tolist()) for i in range(len(texts))]
    assert [len(g) for g in got] == [len(w) for w in want]
    for i, j in itertools.combinations(range(len(texts)), 2):
        assert len(got[i] & got[j]) == len(want[i] & want[j])


def test_blocks_do_not_change_shingles(monkeypatch):
    texts = pa.array([PROSE, None, "a " * 300, "y" * 200 + " b c d e", PROSE])
    whole = shingles.shingle_sets(texts)
    monkeypatch.setattr(shingles, "BLOCK", 64)
    cut = shingles.shingle_sets(texts)
    assert (whole[0] == cut[0]).all() and (whole[1] == cut[1]).all()


def test_components(spark):
    links = spark.createDataFrame([(9, 8), (8, 7), (7, 6), (1, 2), (2, 2), (5, 4), (4, 6)], "a long, b long")
    assert {(r.node, r.root) for r in components.components(links).collect()} == {
        (9, 4), (8, 4), (7, 4), (6, 4), (5, 4), (4, 4), (1, 1), (2, 1),
    }


# --- line rules -----------------------------------------------------------------


def test_line_rules_on_odd_rows(odd, none):
    rows = {r.doc_id: r for r in line_rules.verdicts(odd).collect()}
    assert rows[3].n_words == 0 and rows[3].base_failed and not rows[3].kept
    assert rows[7].n_words == 40_000 and rows[7].kept
    assert rows[1].n_words == 17 and rows[1].kept and rows[1].n_repeat_words == 0
    assert line_rules.verdicts(odd).count() == len(ROWS)
    assert line_rules.verdicts(none).count() == 0 and line_rules.cleaned(none).count() == 0


def test_boilerplate_lines_go(spark, monkeypatch):
    monkeypatch.setattr(line_rules, "MIN_DOCS", 3)
    footer = "All rights reserved by the house, number {} of the year"
    rows = [(i, f"{PROSE} told as story {'uvwxyz'[i]}\n  {footer.format(i)}\nthe end of story {'uvwxyz'[i]}", "en", "a", 0) for i in range(6)]
    rows += [(50, footer.format(3) + " \n" + footer.format(4), "en", "a", 0)]  # nothing else in it
    rows += [(60, footer.format(3) + "\n" + PROSE, "en", "b", 0)]  # another host
    rows += [(70 + i, PROSE + "\none copy", "en", "c", 0) for i in range(9)]  # copies are one document
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    found = {r.doc_id: r for r in line_rules.verdicts(df).collect()}
    assert [i for i, r in found.items() if not r.kept] == [50]
    assert found[0].removed_words == 11 and found[60].removed_words == 0 and found[70].removed_words == 0
    texts = {r.doc_id: r for r in line_rules.cleaned(df).collect()}
    assert 50 not in texts and texts[0].text == f"{PROSE} told as story u\nthe end of story u"
    assert texts[0].n_chars == len(texts[0].text) and texts[60].text == rows[7][1]


def test_boilerplate_of_a_large_host(spark):
    name = F.translate(F.col("doc_id").cast("string"), "0123456789", "abcdefghij")
    text = F.concat(F.lit(f"{PROSE} as story "), name)
    text = F.when(F.col("doc_id") < 22, F.concat(text, F.lit("\nall rights reserved"))).otherwise(text)
    text = F.when(F.col("doc_id") < 20, F.concat(text, F.lit("\nread it again"))).otherwise(text)
    docs = spark.range(4400).select(F.col("id").alias("doc_id")).withColumn("text", text).withColumn("source", F.lit("a"))
    found = {r.doc_id: r.removed_words for r in line_rules.verdicts(docs).collect()}
    assert {i: n for i, n in found.items() if n} == dict.fromkeys(range(22), 3)


def test_repeated_words_by_brute_force(spark):
    rng = np.random.default_rng(1)
    texts = [" ".join(rng.choice(list("abc"), n)) for n in (3, 5, 8, 20, 60)] + ["a b c d e " * 7]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("source", F.lit("s"))
    for r in line_rules.base_measures(df).collect():
        w = texts[r.doc_id].split()
        n = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
        again = {i + j for i in range(len(w) - 4) if n[tuple(w[i : i + 5])] > 1 for j in range(5)}
        assert r.n_repeat_words == len(again)


# --- WARC ------------------------------------------------------------------------

PAGE = """<html><head><title>Tea &amp; <i>x</i></title><script>var t="<p>no</p>";</script></head>
<body><!-- <a href="no"> --><p>One<br>two &lt;3</p><a href='/a?b=1&amp;c=2'>link</a> <img src=pic.png></body></html>"""


def test_derived_records_round_trip(spark):
    pages = spark.createDataFrame([(1, "http://x/1", PAGE), (2, None, None), (2, None, None)], "page_id long, url string, html string")
    rows = [r.asDict() for r in warc.derivatives(warc.responses_of(pages, "2024-01-01T00:00:00Z"), "page_id").collect()]
    assert Counter((r["page_id"], r["record_type"]) for r in rows) == {
        (1, "metadata"): 1, (1, "conversion"): 1, (2, "metadata"): 2, (2, "conversion"): 2,
    }
    text = next(r for r in rows if r["page_id"] == 1 and r["record_type"] == "conversion")
    assert text["content"] == "Tea & x\nOne\ntwo <3\nlink"
    meta = json.loads(next(r["content"] for r in rows if r["page_id"] == 1 and r["record_type"] == "metadata"))
    html = meta["Envelope"]["Payload-Metadata"]["HTTP-Response-Metadata"]["HTML-Metadata"]
    assert [x["url"] for x in html["Links"]] == ["/a?b=1&c=2", "pic.png"]
    back = list(warc.parsed(b"".join(map(warc.written, rows))))
    assert len(back) == len(rows)
    for record, row in zip(back, rows, strict=True):
        given = {h["name"]: h["value"] for h in record["headers"]}
        assert given["WARC-Refers-To"] == row["refers_to"] and record["record_id"] == row["record_id"]
        assert record["block"].decode() == row["content"] and warc.digest(record["block"]) == row["block_digest"]
    empty = warc.responses_of(pages.limit(0), "2024-01-01T00:00:00Z")
    assert warc.derivatives(empty, "page_id").count() == 0


# --- language ----------------------------------------------------------------------


def test_forward_sums_all_segmentations():
    pieces = lang_id.vocabulary(lang_id.default_vocabulary())
    table = np.random.default_rng(3).random((len(pieces.pieces), 2))
    table /= table.sum(axis=0)

    def brute(word):
        if not word:
            return np.ones(2)
        return sum(
            (table[pieces.number[word[:k]]] * brute(word[k:]) for k in range(1, len(word) + 1) if word[:k] in pieces.number),
            np.zeros(2),
        )

    for word in (b" the", b" xyzzy", "größe".encode()):
        letters = np.frombuffer(word, np.uint8).reshape(1, -1)
        got = np.log(lang_id.forward(pieces, letters, lang_id._scaled(pieces, table))[0]) - len(word) * math.log(lang_id._SCALE)
        assert np.allclose(got, np.log(brute(word)))
        assert np.allclose(lang_id.long_word(pieces, word, np.log(table)), np.log(brute(word)))
        counts = lang_id.expected(pieces, letters, np.ones(1), lang_id._scaled(pieces, table)[:, 0])
        assert math.isclose(counts @ np.array([len(p) for p in pieces.pieces]), len(word))


def test_language_of_held_out_documents(spark, tiny):
    docs = spark.read.parquet(f"{tiny}/documents.parquet").select("doc_id", "lang")
    found = q.segmentation_language_id(spark, tiny).join(docs, "doc_id").filter("held_out")
    right, n = found.agg(F.count_if(F.expr("lang = lang_pred")), F.count(F.lit(1))).first()
    assert n > 20 and right / n >= 0.97


def test_language_of_odd_rows(odd, none):
    langs, table = lang_id.fit(odd)
    assert langs == ["de", "en"]
    rows = lang_id.predict(odd, langs, table).collect()
    found = {r.doc_id: (r.lang_pred, r.score) for r in rows}
    assert len(rows) == len(ROWS) and rows[0]["n"] == "old n"
    assert [found[i] for i in (3, 4, 5, 6)] == [("und", 0.0)] * 4
    assert found[1][0] == "en" and found[10][0] == "de" and 0.5 <= found[9][1] <= 1
    langs, table = lang_id.fit(none)
    assert langs == [] and {r.lang_pred for r in lang_id.predict(odd, langs, table).collect()} == {"und"}


# --- neighbours --------------------------------------------------------------------------


def brute_neighbours(rows, k):
    out = {}
    for i, v in rows:
        if i % 20 == 0:
            scores = [(-sum(x * y for x, y in zip(v, w, strict=True)), j) for j, w in rows if j != i]
            out[i] = [j for _, j in sorted(scores)[:k]]
    return out


def test_neighbours_of_odd_vectors(spark):
    rng = np.random.default_rng(5)
    rows = [(i, np.float32(rng.normal(size=6)).tolist()) for i in range(100)]
    rows += [(200 + i, rows[0][1]) for i in range(40)]  # one vector many times
    bad = [(300, None), (320, [0.0] * 6), (340, [None] * 6), (360, [float("nan")] * 6), (380, [1.0, 2.0]), (None, rows[1][1])]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<float>").withColumn("rank", F.lit(1))
    got = defaultdict(list)
    for r in ann.nearest(df, F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect():
        got[r.query_id].append(r.vec_id)
    assert got == brute_neighbours(rows, 20)
    assert ann.nearest(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0
    few = ann.nearest(df.filter("vec_id < 3"), F.col("vec_id") % 20 == 0).collect()
    assert len(few) == 2


def test_recall(spark, small):
    ids, vectors = zip(*spark.read.parquet(f"{small}/embeddings.parquet").select("vec_id", "embedding").collect(), strict=True)
    matrix = np.array(vectors, dtype=float)
    sample, longest = ann._lifted(matrix, 1.01), 1.01
    forest = [ann.grown(sample, 8, t) for t in range(ann.TREES)]
    sizes = [np.bincount(ann.leaves(t, sample), minlength=t.n_leaves) for t in forest]
    assert all(s.sum() == len(ids) for s in sizes) and longest > 1
    found = defaultdict(set)
    for r in q.projection_forest_search(spark, small).collect():
        found[r.query_id].add(r.vec_id)
    hits = [len(found[i] & set(w)) / 20 for i, w in brute_neighbours(list(zip(ids, matrix.tolist(), strict=True)), 20).items()]
    assert np.mean(hits) >= 0.9


# --- Kneser-Ney ----------------------------------------------------------------------------


def brute_perplexity(trusted, text):
    n = kn_quality.ORDER
    pad = kn_quality.PAD * (n - 1)
    counts = {n: Counter(p[i : i + n] for t in trusted for p in [pad + t] for i in range(len(t)))}
    for k in range(n - 1, 0, -1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])
    off = {k: kn_quality.discounts(*[sum(v == c for v in counts[k].values()) for c in (1, 2, 3, 4)]) for k in counts}
    cut = lambda k, c: off[k][min(c, 3) - 1]

    def p(g):
        k = len(g)
        lower = p(g[1:]) if k > 1 else 1 / (len(counts[1]) + 1)
        same = {h: c for h, c in counts[k].items() if h[:-1] == g[:-1]}
        total = sum(same.values())
        if not total:
            return lower
        own = counts[k].get(g, 0)
        return (max(own - cut(k, own), 0) if own else 0) / total + sum(cut(k, c) for c in same.values()) / total * lower

    logs = [math.log(p((pad + text)[i : i + n])) for i in range(len(text))]
    return math.exp(-sum(logs) / len(logs))


def test_perplexity_by_brute_force(spark):
    texts = [f"{w} the cat {w} sat on a mat" for w in "one two three four five six seven eight".split()] + ["qqzz ttt"]
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1) for i in range(8)] + [(8, 0), (None, 1)], "doc_id long, quality int")
    rows = kn_quality.perplexities(docs, labels).collect()
    trusted = [texts[r.doc_id] for r in rows if r.held is not None and not r.held]
    assert 0 < len(trusted) < 8
    for r in rows:
        assert math.isclose(r.perplexity, brute_perplexity(trusted, texts[r.doc_id]), rel_tol=1e-9)


def test_quality_of_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(1, 1), (2, 1), (7, 1), (10, 1), (99, 1)], "doc_id long, quality int")
    rows = {r.doc_id: r for r in kn_quality.filtered(odd, labels).collect()}
    assert rows[3].perplexity is None and not rows[3].kept and rows[None].perplexity > 1
    assert kn_quality.filtered(odd, labels).count() == len(ROWS)
    assert kn_quality.filtered(none, labels).count() == 0
    assert kn_quality.filtered(odd, labels.limit(0)).filter("kept").count() == len(ROWS) - 2


def test_many_different_characters():
    texts = pa.array(["".join(chr(0x4E00 + i) for i in range(9000)), "abc", None, "abcab"])
    wide, narrow = kn_quality.Grams(texts), kn_quality.Grams(texts.slice(1))
    assert not wide.direct and narrow.direct
    for grams in (wide, narrow):
        keys, n = grams.counted()
        own = dict(zip(grams.spelled(keys), n.tolist(), strict=True))
        pad = kn_quality.PAD * 3
        assert own[pad + "a"] == 2 and own["abca"] == own["bcab"] == 1 and "aabc" not in own
        assert (grams.looked_up(list(own), n) == n[np.searchsorted(keys, grams.keys)]).all()


def test_model_sees_the_order_of_words(spark):
    words = [f"{a}{b}" for a in ("stone", "river", "cloud", "green") for b in ("wall", "side", "light", "field")]
    rng = np.random.default_rng(0)
    line = " ".join(rng.permutation(words))
    texts = [f"{line} {words[i % 16]}" for i in range(60)]
    back = " ".join(line.split()[::-1]) + f" {words[0]}"  # the same words and nearly the same characters
    rows = [(i, t, "en") for i, t in enumerate([*texts, back])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1) for i in range(60)], "doc_id long, quality int")
    found = {r.doc_id: r for r in kn_quality.filtered(docs, labels).collect()}
    encode = packing.encoding(public_tokenizers.path(kn_quality.VOCABULARY)).encode_ordinary
    assert [found[i].n_scored for i in range(61)] == [len(encode(t)) for _, t, _ in rows]
    assert all(found[i].kept for i in range(60)) and not found[60].kept
    assert found[60].threshold <= max(found[i].perplexity for i in range(60))


def test_numbers_of_ngrams():
    texts = pa.array(["ab\uc4ff\u0100b", "", "ba"])
    grams = kn_quality.Grams(texts)
    keys, _ = grams.counted()
    assert kn_quality.spelled(grams.numbers(keys)).tolist() == grams.spelled(keys)


# --- toxicity ----------------------------------------------------------------------------------


def test_toxic_documents_are_found(spark, small):
    labels = spark.read.parquet(f"{small}/labels.parquet").select("doc_id", F.col("toxic").alias("truth"))
    found = q.toxicity_chain(spark, small).join(labels, "doc_id")
    hit, said, true = found.agg(
        F.count_if(F.expr("toxic and truth = 1")), F.count_if("toxic"), F.count_if(F.expr("truth = 1"))
    ).first()
    assert hit / true >= 0.8 and hit / said >= 0.8


def test_toxicity_of_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(1, 0, 1), (2, 1, 0), (7, None, 1)], "doc_id long, a int, b int")
    chain = toxicity.fit(odd, labels, ["a", "b"])
    rows = toxicity.predict(odd, chain).collect()
    assert len(rows) == len(ROWS) and all(0 <= r.p_a <= 1 and 0 <= r.p_b <= 1 for r in rows)
    chain = toxicity.fit(none, labels.limit(0), ["a", "b"])
    assert toxicity.predict(none, chain).count() == 0 and chain.words == []


# --- packing ----------------------------------------------------------------------------------------


def test_pieces_and_places(spark, odd, none):
    rows = [r.asDict() for r in packing.packed_documents(odd, 2048).collect()]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = Counter()
    for doc_id, text, *_ in ROWS:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        for piece, (start, n) in enumerate(packing.cuts(len(ids), 2048)):
            crc = zlib.crc32(np.array(ids[start : start + n], "<u4").tobytes())
            want[doc_id, piece, start, n, crc] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == want
    by = defaultdict(list)
    for r in rows:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in by.values():
        ends = list(itertools.accumulate(n for _, n in sorted(places)))
        assert [o for o, _ in sorted(places)] == [0, *ends[:-1]] and ends[-1] <= 2048
    assert packing.packed_documents(none, 2048).count() == 0


def test_rounds_close_gaps(spark):
    rng = np.random.default_rng(2)
    sizes = rng.integers(1, 101, 3000)
    pieces = spark.createDataFrame([(i, int(n)) for i, n in enumerate(sizes)], "item long, length long")
    placed = packing.pack(pieces, 100, per_partition=200).join(pieces, "item").collect()
    assert len(placed) == 3000
    bins = len({r.sequence_id for r in placed})
    one = int(packing.best_fit(np.sort(sizes)[::-1], 100).max()) + 1
    assert packing.lower_bound(sizes, 100) <= bins <= 1.03 * one


def test_bound_is_below_every_packing():
    rng = np.random.default_rng(4)
    for _ in range(60):
        sizes = rng.integers(1, 21, rng.integers(1, 8))
        best = len(sizes)
        for bins in itertools.product(range(len(sizes)), repeat=len(sizes)):
            fill = np.bincount(bins, sizes, minlength=len(sizes))
            if fill.max() <= 20:
                best = min(best, int((fill > 0).sum()))
            if len(sizes) > 5:
                break
        assert packing.lower_bound(sizes, 20) <= best
    assert packing.lower_bound(np.array([11, 11, 11]), 20) == 3


def test_tokenizer_reads_its_file():
    encoding = packing.encoding(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for text in ("it's 12 o'clock\n\n  now", "日本語 ñandú  x", "\x00\x1f é"):
        assert encoding.encode_ordinary(text) == tokenizer.encode(text, add_special_tokens=False).ids
    assert base64.b64decode(b"IQ==") == b"!"


def test_added_token_in_a_text(spark):
    texts = ["hello <|endoftext|> world", "<|endoftext|><|endoftext|>", "a <|endoftext|", "  <|endoftext|>\n x"]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r.doc_id: r for r in packing.packed_documents(docs).collect()}
    for i, text in enumerate(texts):
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, packing.END_ID]
        assert rows[i].length == len(ids) and rows[i].ids_crc32 == zlib.crc32(np.array(ids, dtype="<u4").tobytes())
    assert rows[0].length == 5


# --- shards and mixture --------------------------------------------------------------------------------


@pytest.mark.parametrize("n", [1, 2, 3, 7, 100, 1000])
def test_permutation(spark, n):
    rows = spark.range(n).select(sharding.permuted(F.col("id"), n, 5).alias("p")).collect()
    assert sorted(r.p for r in rows) == list(range(n))


def test_shards_of_odd_rows(odd, none):
    rows = sharding.shard(odd, "doc_id", ["text"], 5).collect()
    assert Counter(r.shard for r in rows) == {0: 3, 1: 3, 2: 2, 3: 2, 4: 2}
    assert all(sorted(r.slot for r in rows if r.shard == s) == list(range(2 + (s < 2))) for s in range(5))
    assert sharding.shard(none, "doc_id", ["text"], 5).count() == 0
    again = sharding.shard(odd.repartition(3), "doc_id", ["text"], 5).collect()
    place = lambda rs: sorted((str(r.doc_id), r.shard, r.slot) for r in rs)
    assert place(again) == place(rows)


def test_mixture_of_odd_rows(odd, none):
    sized = odd.withColumn("size", mixing.word_count(F.col("text")))
    mixed = mixing.mix(sized, "size", ["text"], [3, 1, 2])
    rows = mixed.collect()
    assert len(rows) == len(ROWS)
    by = defaultdict(list)
    for r in rows:
        by[r.source].append(r)
    total = sum(r["size"] for r in rows)
    assert math.isclose(sum(own[0].target for own in by.values()), 1.5 * total)
    for own in by.values():
        assert sum(r.taken for r in own) == math.floor(own[0].target)
        assert all(r.taken <= 2 * r["size"] for r in own) and own[0].target <= 2 * own[0].source_size
    copies = mixing.repeated(mixed, "size").select("doc_id", mixing.word_count(F.col("text")).alias("words"))
    assert copies.agg(F.sum("words")).first()[0] == sum(r.taken for r in rows)
    empty = none.withColumn("size", F.lit(0))
    assert mixing.mix(empty, "size", ["text"], [3, 1, 2]).count() == 0


# --- pipeline ------------------------------------------------------------------------------------------------


def test_stages_on_odd_rows(spark, odd, none, tmp_path):
    docs, names = odd, ["doc_id", "text", "lang", "source", "n_chars"]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        assert stage(spark, none, "").count() == 0
        out = stage(spark, docs, "")
        out.write.parquet(str(tmp_path / str(i)))
        docs = spark.read.parquet(str(tmp_path / str(i)))
        assert i == 4 or docs.columns == names
    assert {r.doc_id for r in docs.collect()} >= {1, 7}


def test_pipeline_is_its_stages(spark, tiny):
    docs = spark.read.parquet(f"{tiny}/documents.parquet")
    packed = corpus_pipeline.run(spark, tiny)
    kept = packed.select("doc_id").distinct().join(docs, "doc_id").count()
    assert 0.5 * docs.count() < kept <= docs.count()
    fill = packed.groupBy("sequence_id").agg(F.sum("length").alias("n"))
    assert fill.agg(F.max("n")).first()[0] <= 2048


# --- language: marks and long runs -------------------------------------------------


def test_marks_alone_are_no_word(spark):
    docs = [(i, "der hund und die katze" if i % 2 else "the dog and the cat", "de" if i % 2 else "en") for i in range(20)]
    langs, table = lang_id.fit(spark.createDataFrame(docs, "doc_id long, text string, lang string"))
    odd = [(1, "́̂"), (2, "é"), (3, "12 ̈ !"), (4, "the ́")]
    got = lang_id.predict(spark.createDataFrame(odd, "doc_id long, text string"), langs, table).collect()
    assert {r.doc_id: r.lang_pred == "und" for r in got} == {1: True, 2: False, 3: True, 4: False}


def test_long_runs_are_learned(spark):
    """A script without blanks, whose letter runs all have over 40 bytes."""
    thai, greek = "กขคงจฉชซ" * 6, "αβγδεζηθ" * 9
    docs = [(i, (thai if i % 2 else greek)[i % 5 :], "th" if i % 2 else "el") for i in range(40)]
    langs, table = lang_id.fit(spark.createDataFrame(docs, "doc_id long, text string, lang string"))
    new = [(1, "ชซกขคงจฉ" * 5), (2, "ηθαβγδεζ" * 6)]
    got = lang_id.predict(spark.createDataFrame(new, "doc_id long, text string"), langs, table).collect()
    assert {r.doc_id: r.lang_pred for r in got} == {1: "th", 2: "el"}
    # Both ways of counting agree on words that either can take.
    pieces = lang_id.vocabulary(lang_id.default_vocabulary())
    for word in (b" straffen", b" the", " größe".encode()):
        rows = np.frombuffer(word, np.uint8).reshape(1, -1)
        whole = lang_id.expected(pieces, rows, np.ones(1), lang_id._scaled(pieces, table)[:, 0])
        single = np.zeros(len(whole))
        np.add.at(single, *lang_id.long_expected(pieces, word, np.log(table)[:, 0]))
        assert np.allclose(whole, single)
