"""Operators against plain versions on odd rows and the smallest given table."""

import hashlib

import duckdb
import numpy as np
import plain
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from clipwarden.llm import bpe, debruijn, exact, licenses, minhash, packing, queries, syncmers, tokens, toxicity, urls, wavelet
from clipwarden.session import scratch_path

PATH = public_tokenizers.path("byte_bpe_50k.json")
TOKENIZER = Tokenizer.from_file(PATH)


def ids_of(text):
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


TEXTS = st.text(st.sampled_from("ab é\n\t \u00a0\u2003'’1.,<|>zß日🎉"), max_size=40)


@settings(max_examples=400, deadline=None)
@given(TEXTS)
def test_both_encoders_match_the_library(text):
    want = plain.u32(ids_of(text))
    assert tokens.block_encoder(PATH)([text, text + " x", text]) == [want, plain.u32(ids_of(text + " x")), want]
    assert bpe.prefix_encoder(PATH)[0](text) == want


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 40), max_size=1500))
def test_wavelet_matrix_answers(values):
    ids = np.array(values, np.uint32)
    m = wavelet.WaveletMatrix.from_bytes(wavelet.WaveletMatrix.build(ids).to_bytes())
    assert m.decode().tolist() == values
    for i in range(0, len(values), 97):
        assert m.access(i) == values[i]
        assert m.rank(values[i], i) == values[:i].count(values[i])
        assert m.select(values[i], m.rank(values[i], i)) == i
    assert m.rank(63) == values.count(63)


def test_wavelet_shards(spark, odd, odd_rows):
    path = scratch_path(spark, "shards")
    wavelet.write_shards(odd, path, PATH, partitions=3, shard_tokens=500)
    docs, _ = wavelet.read_documents(spark, path)
    assert {r.doc_id: bytes(r.ids) for r in docs.collect()} == {k: plain.u32([*ids_of(t), 0]) for k, t in odd_rows}
    got, at = by_id(wavelet.shard_documents(spark, path)), 0
    for key, text in sorted(odd_rows):
        assert (got[key].start, got[key].n_tokens) == (at, len(ids_of(text)) + 1)
        at += got[key].n_tokens
    token = ids_of(" don")[0]
    where = {(k, i) for k, t in odd_rows for i, x in enumerate(ids_of(t)) if x == token}
    assert {tuple(r) for r in wavelet.find_token(spark, path, token).collect()} == where
    assert sum(r.n for r in wavelet.count_token(spark, path, token).collect()) == len(where)


def test_wavelet_ties_and_nothing(spark, make, empty):
    path = scratch_path(spark, "ties")
    wavelet.write_shards(make([(1, "b"), (1, "a"), (1, "a"), (None, "c")]), path, PATH)
    assert sorted(r.start for r in wavelet.shard_documents(spark, path).collect()) == [0, 2, 4, 6]
    path = scratch_path(spark, "nothing")
    wavelet.write_shards(empty, path, PATH)
    assert wavelet.shard_documents(spark, path).count() == 0


def test_packing(odd, odd_rows, empty, make):
    pieces = packing.pack(odd, PATH).collect()
    got, seen = {}, set()
    for p in pieces:
        got.setdefault(p.doc_id, []).append(p)
        assert p.sequence_id not in seen and p.offset == 0 and p.length & (p.length - 1) == 0 and p.length <= 1024
        seen.add(p.sequence_id)
    for key, text in odd_rows:
        own = sorted(got[key], key=lambda p: p.start)
        assert b"".join(bytes(p.ids) for p in own) == plain.u32([*ids_of(text), 0])
        assert [p.length for p in own] == packing.piece_lengths(len(ids_of(text)) + 1)
    assert packing.pack(empty, PATH).count() == 0
    assert packing.pack(make([(1, "a"), (1, "a"), (None, None)]), PATH).count() == 3


def test_prefix_bpe(odd, odd_rows, empty):
    got = by_id(bpe.encode_decode(odd, PATH))
    for key, text in odd_rows:
        assert bytes(got[key].ids) == plain.u32(ids_of(text))
        assert got[key].decoded == TOKENIZER.decode(ids_of(text), skip_special_tokens=False)
    assert bpe.encode_decode(empty, PATH).count() == 0


def test_exact(odd, odd_rows, given_rows, make, empty):
    for rows, df in ((odd_rows, odd), (given_rows, make(given_rows))):
        want = plain.exact(rows)
        got = {r.doc_id: (r.keep_id, r.group_size) for r in exact.exact_duplicates(df).collect()}
        assert got == want
        # few counters: groups are decided on both ways
        assert {r.doc_id: (r.keep_id, r.group_size) for r in exact.exact_duplicates(df, counters=3).collect()} == want
    assert exact.exact_duplicates(empty).count() == 0
    rows = exact.exact_duplicates(make([(1, "a"), (1, "a"), (2, "a"), (None, "a")])).collect()
    assert sorted((r.doc_id or 0, r.kept, r.group_size) for r in rows) == [(0, False, 4), (1, True, 4), (1, True, 4), (2, False, 4)]


def test_misra_gries_bounds():
    items = [b"a"] * 50 + [bytes([i]) for i in range(100)] + [b"a"] * 10
    held = exact.misra_gries(items, 4)
    assert len(held) <= 4 and 60 - len(items) / 5 <= held[b"a"] <= 60


def test_near(odd, odd_rows, given_rows, make, empty):
    for rows, df in ((odd_rows, odd), (given_rows, make(given_rows))):
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(df, threshold=0.85).collect()}
        assert got == plain.near(rows, 85)
    assert minhash.near_duplicates(empty).count() == 0
    rows = minhash.near_duplicates(make([(1, "a b"), (1, "a b"), (2, "A b"), (None, "c")])).collect()
    assert sorted((r.doc_id or 0, r.kept) for r in rows) == [(0, True), (1, True), (1, True), (2, False)]


def test_near_group_with_a_centre(make):
    """Copies of one text that are near it but mostly not near each other, and one that only another copy links."""
    import random

    rnd = random.Random(1)
    words = [f"w{i}" for i in range(400)]
    rows = [(500, " ".join(words))]
    for key in range(60):
        own = list(words)
        for at in rnd.sample(range(400), 6 if key % 3 else 14):
            own[at] = f"x{key}_{at}"
        rows.append((key, " ".join(own)))
    chain = rows[5][1].split()
    for at in range(50, 55):
        chain[at] = f"y{at}"
    rows.append((501, " ".join(chain)))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(make(rows), threshold=0.85).collect()}
    assert got == plain.near(rows, 85)


def test_estimate_is_corrected_for_chance(spark):
    rng = np.random.default_rng(0)
    minima = minhash.Minima(128, 4, 4)
    for shared in (0, 500, 900):
        both, own = rng.integers(0, 1 << 63, (2, 1000), np.uint64)
        other = np.concatenate((both[:shared], own[shared:]))
        a, b = (minima.packed(minima.minima(x)).tolist() for x in (both, other))
        df = spark.createDataFrame([(a, b)], "a array<bigint>, b array<bigint>")
        got = df.select(minhash.estimate("a", "b", 128, 4).alias("e")).first().e
        assert abs(got - shared / (2000 - shared)) < 0.17


def test_repeats(odd, odd_rows, given_rows, make, empty):
    for rows, df in ((odd_rows, odd), (given_rows, make(given_rows))):
        found = debruijn.deduplicated(df).collect()
        assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in found} == plain.repeats(rows)
        for r in found:
            if r.kept_text is not None:
                assert plain.sha(b" ".join(r.kept_text.encode().split())) == r.kept_sha256
    assert debruijn.deduplicated(empty).count() == 0


def test_repeats_of_repeated_rows(make):
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(1, text), (1, text), (2, text), (2, text), (None, text), (3, "short")]
    got = sorted((r.doc_id or 0, r.n_removed) for r in debruijn.deduplicated(make(rows)).collect())
    assert got == [(0, 30), (1, 0), (1, 0), (2, 30), (2, 30), (3, 0)]


def test_syncmers(odd, odd_rows, make, empty):
    got, rows = by_id(syncmers.fingerprints(odd)), sorted(odd_rows)
    for i, (key, text) in enumerate(rows):
        text, after = text or "", rows[(i + 1) % len(rows)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        r = got[key]
        assert (r.n_chars, r.edited_sha256) == (len(text), plain.sha(edited))
        assert r.fingerprint == syncmers.Sketch.of(text).text() and r.edited_fingerprint == syncmers.Sketch.of(edited).text()
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    assert got[16].fingerprint == got[17].fingerprint and got[16].near_next == 1.0
    assert got[17].near_next > 0.6 > got[18].near_edited
    assert syncmers.fingerprints(empty).count() == 0
    one = syncmers.fingerprints(make([(1, "only one text here, which is its own next")])).first()
    assert one.near_next == 1.0
    assert syncmers.fingerprints(make([(1, "b"), (1, "a"), (1, "a"), (None, None)])).count() == 4


def test_syncmers_are_context_free():
    text = "the quick brown fox jumps over the lazy dog and runs away from all the hounds"
    plain_anchors = {int(h) for h in syncmers.anchors(text)[0]}
    moved = {int(h) for h in syncmers.anchors("xx " + text + " yy")[0]}
    assert plain_anchors and plain_anchors <= moved


def test_syncmers_of_long_texts_and_insertions():
    rng = np.random.default_rng(4)
    words = ["".join(rng.choice(list("abcdefghijklmnop"), 6)) for _ in range(20_000)]
    long, part = " ".join(words), " ".join(words[9000:9200])
    whole, piece = syncmers.Sketch.of(long), syncmers.Sketch.of(part)
    assert set(piece.hashes.tolist()) <= set(whole.hashes.tolist())
    assert 0.9 < piece.likeness(whole) * len(whole.hashes) / len(piece.hashes) <= 1.0
    text = words[:400]
    inserted = text[:200] + words[500:510] + text[200:]
    moved = text[200:] + text[:200]
    often = [w for i in range(0, 400, 40) for w in [*text[i : i + 40], *words[600 + i : 605 + i]]]
    own = syncmers.Sketch.of(" ".join(text))
    assert own.likeness(syncmers.Sketch.of(" ".join(inserted))) > 0.9
    assert own.likeness(syncmers.Sketch.of(" ".join(moved))) > 0.9
    assert own.likeness(syncmers.Sketch.of(" ".join(often))) > 0.7
    assert own.likeness(syncmers.Sketch.of(" ".join(words[1000:1400]))) < 0.05
    back = syncmers.Sketch.parse(own.text())
    assert back.likeness(own) == 1.0


def test_urls(spark):
    odd = [
        None, "", "no scheme", "http://", "HTTP://Www.Example.COM/en/1", "x://example.com/en/", "x://example.com?en/",
        "http://a.example.com#/en/", "http://net/es/1", "http://a.net/fr/", "http://anet/fr/", "http://com", "http://com/",
        "http://xample.com/en/", "http://ÄÖ.com/en/", "a://b://c.com/x", "http://" + "y" * 3000 + ".com/" + "z" * 3000,
    ]
    df = spark.createDataFrame([(i, u, "r", "v", 1) for i, u in enumerate(odd)] * 2, "page_id int, url string, rule string, verdict string, score int")
    got = urls.judge(df, urls.train(urls.seed_table(spark)), queries.URL_RULES).collect()
    assert len(got) == 2 * len(odd)
    for r in got:
        host, path = split_url(odd[r.page_id])
        fits = [x for x in queries.URL_RULES if (host == x.host or host.endswith("." + x.host)) and path.startswith(x.path)]
        best = max(fits, key=lambda x: len(x.text), default=None)
        assert (r.host, r.path, r.rule) == (host, path, best.text if best else None)
        assert r.verdict == (best.verdict if best else ("block" if r.score >= 0.5 else "allow"))
    assert urls.judge(df.limit(0), urls.train(urls.seed_table(spark))).count() == 0


def split_url(url):
    import re

    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return host.translate(str.maketrans(upper, upper.lower())), re.match(r"[^?#]*", rest[len(host) :]).group()


def test_url_model_on_unseen_hosts(spark):
    bad = ["cheap-casino.example.org/en/4", "www.free-pills.example.com/de/9", "spam-bets.example.net/fr/1"]
    good = ["library-news.example.org/en/4", "www.garden.example.com/de/9", "thentor.example.org/en/1"]
    df = spark.createDataFrame([(i, "https://" + u) for i, u in enumerate(bad + good)], "page_id int, url string")
    got = {r.page_id: r.score for r in urls.judge(df, urls.train(urls.seed_table(spark))).collect()}
    assert min(got[i] for i in range(3)) > max(got[i] for i in range(3, 6))


def test_url_scores_against_a_plain_sum(spark):
    """Grams by slicing, their weights added up and squashed; one url of a million characters among them."""
    odd = ["https://a.com/é😀b/c?x", "http://x", "", None, "http://" + "ab" * 20, "q://", "http://h/" + "xyzß" * 250_000]
    df = spark.createDataFrame(list(enumerate(odd)), "page_id int, url string")
    model, hashing = urls.train(urls.seed_table(spark)), urls.hashing()
    weights = model.coefficients.toArray()
    got = urls.judge(df, model).collect()
    assert len(got) == len(odd)
    for r in got:
        marked = "^" + "".join(split_url(odd[r.page_id])) + "$"
        grams = {marked[i : i + n] for n in urls.GRAMS for i in range(len(marked) - n + 1)}
        total = model.intercept + sum(weights[k] for k in {hashing.indexOf(g) for g in grams})
        assert r.score == pytest.approx(1 / (1 + np.exp(-total)), abs=1e-9)


def test_toxicity(spark, make, empty):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").select("doc_id", "toxic")
    scored = toxicity.score(docs, labels).join(labels, "doc_id").filter(toxicity.held_out()).select("score", "toxic").toPandas()
    order = scored.score.rank()
    good = int(scored.toxic.sum())
    auc = (order[scored.toxic == 1].sum() - good * (good + 1) / 2) / (good * (len(scored) - good))
    assert auc > 0.85
    odd = make([(1, None), (2, ""), (2, ""), (3, "idiot"), (None, "... ---"), (4, "x" * 100_000)])
    rows = toxicity.score(odd, labels, carry=True)
    assert rows.count() == 6 and rows.select("row.*").columns == odd.columns
    assert {r.score for r in toxicity.score(odd, labels.limit(0)).collect()} == {0.0}
    assert toxicity.score(empty, labels).count() == 0


def test_toxicity_of_spaced_insults(spark, make):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").select("doc_id", "toxic")
    model = toxicity.train(docs.select("doc_id", "text"), labels.withColumnRenamed("toxic", "label"))
    forms = ["idiot moron", "i d i o t, m o r o n", "id iot mor on", "i--d--i--o--t m..o..r..o..n", "garden kitchen"]
    odd = make([(i, f"the house {f} stands there") for i, f in enumerate(forms)]).select("doc_id", "text")
    rows = toxicity.text_margins(odd, model.table, model.bias, model.longest, model.floor).collect()
    a, b, c = model.curve
    got = {r.doc_id: 1 / (1 + np.exp(-(a * r.best + b * r.second + c))) for r in rows}
    assert min(got[i] for i in range(4)) >= 0.7 > got[4]


def test_toxicity_of_few_labels(spark, make):
    """With both labels present a model is trained, however few texts there are."""
    bad = [(k, f"you are an idiot today {w}") for k, w in enumerate(["north", "south", "east", "west"])]
    good = [(k + 10, f"the garden is green and {w}") for k, w in enumerate(["warm", "wide", "old", "calm"])]
    labels = spark.createDataFrame([(k, 1) for k, _ in bad] + [(k, 0) for k, _ in good], "doc_id bigint, toxic int")
    got = {r.doc_id: r.score for r in toxicity.score(make(bad + good), labels.filter(~toxicity.held_out())).collect()}
    assert min(got[k] for k, _ in bad) > max(got[k] for k, _ in good)


def test_kernel_tolerates_gaps():
    toxic = ["idiot", "moron", "worthless", "pathetic"]
    toxic += [v for w in toxic for v in toxicity.disguised(w)]
    rng = np.random.default_rng(3)
    clean = ["".join(rng.choice(list("aeinorst"), rng.integers(3, 9))) for _ in range(400)]
    table, bias = toxicity.train_machine(toxic, clean)
    got = dict(zip(*[words := ["idiot", "idi-ot", "mo*ron", "w.o.r.t.h.l.e.s.s", "on", "station"], toxicity.margins(words, table, bias)]))
    assert min(got["idiot"], got["idi-ot"], got["mo*ron"], got["w.o.r.t.h.l.e.s.s"]) > max(got["on"], got["station"])


def test_spaced_and_doubly_gapped_insults():
    toxic = ["idiot", "moron", "worthless", "pathetic"]
    toxic += [v for w in toxic for v in toxicity.disguised(w)]
    rng = np.random.default_rng(3)
    clean = ["".join(rng.choice(list("aeinorst"), rng.integers(3, 9))) for _ in range(400)]
    table, bias = toxicity.train_machine(toxic, clean)
    gapped = toxicity.margins(["i--d--i--o--t", "m**o**r**o**n", "w-.o-.r-.t-.h-.l-.e-.s-.s"], table, bias)
    assert gapped.min() > max(0.5, toxicity.margins(["on", "station", "nation-state"], table, bias).max())
    texts = ["on i d i o t station", "on id iot", "on m - o r - o n, station", "on station", "", "...", "on"]
    spans = toxicity.Spans(texts, table, bias)
    every = np.arange(len(spans.words))
    assert np.allclose(spans.margins(every, every), toxicity.margins(spans.words, table, bias))
    for first, last in spans.joins(9):
        joined = [spans.join(a, z) for a, z in zip(first, last)]
        assert max(map(len, joined)) <= 9
        assert np.allclose(spans.margins(first, last), toxicity.margins(joined, table, bias))
    best, second = spans.two_highest(9, -9.0)
    whole = toxicity.margins(["idiot", "idiot", "moron", "on", "", "on"], table, bias)
    assert (best[:3] >= whole[:3] - 1e-9).all() and best[:3].min() > 0.5 > best[3:].max()
    assert second[:3].max() < 0.5 and (best[4], second[4]) == (toxicity.LOWEST, toxicity.LOWEST)
    assert np.allclose(best[5:], whole[4:]) and np.allclose(second[5:], whole[4:])


def test_folded_machine_equals_kernel_sums():
    words, marks = ["abc", "abdc", "xyz-abc"], ["abc", "bcd"]
    owner, found, weight = toxicity.subsequences(marks)
    scale = toxicity.norms(owner, weight, 2)
    table = np.zeros(toxicity.CLASSES**3)
    np.add.at(table, found, weight * np.array([0.5, -2.0])[owner] / scale[owner])
    assert np.allclose(toxicity.margins(words, table, 0.1), toxicity.kernel(words, marks) @ [0.5, -2.0] + 0.1)


def test_licenses(make, empty, odd):
    apache = licenses.TEMPLATES[1][1]
    rows = [
        (1, "Some text.\nReleased under the MIT License."), (2, "é licensed UNDER the\tGNU general public license version 3 é"),
        (3, apache.replace("compliance", "xx compliance yy").replace("obtain ", "")), (4, "the license of this is unknown"),
        (5, "Released under the MIT License. " * 2), (5, "Released under the MIT License. " * 2), (6, None), (7, "Released"),
        (8, "Released under the new MIT License"),
    ]
    got = [(r.doc_id, r.license, r.template) for r in licenses.scan(make(rows)).collect()]
    assert sorted(got) == [(1, "MIT", 7), (2, "GPL-3.0", 5), (3, "Apache-2.0", 1), *[(5, "MIT", 7)] * 4, (8, "MIT", 7)]
    spans = {r.doc_id: r for r in licenses.scan(make(rows)).collect()}
    assert rows[0][1][spans[1].start_char : spans[1].end_char] == "Released under the MIT License"
    assert spans[3].coverage > 0.95 and spans[8].coverage == 1.0
    assert licenses.scan(empty).count() == 0 and licenses.scan(odd).count() == 0


def test_license_lines_of_the_given_table(spark, given_rows, make):
    """Every row of the table against a plain search for the templates' words."""
    import re

    def words(text):
        return re.sub(r"[\x00-\x7f]", lambda m: m.group() if m.group().isalnum() else " ", (text or "").lower()).split()

    want = set()
    for key, text in given_rows:
        own = words(text)
        for name, template in licenses.TEMPLATES:
            t = words(template)
            if any(own[i : i + len(t)] == t for i in range(len(own) - len(t) + 1)):
                want.add((key, name))
    assert {(r.doc_id, r.license) for r in licenses.scan(make(given_rows)).collect() if r.coverage == 1} >= want


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query_columns_and_rows(spark, name, sf):
    got = queries.QUERIES[name](spark, sf)
    n = spark.read.parquet(f"{sf}/{'pages' if name.startswith('op6_') else 'documents'}.parquet").count()
    if not name.startswith(("op5_", "op9_")):
        assert got.count() == n
    if name in queries.ORACLES:
        from check_queries import rows_of

        con = duckdb.connect()
        con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
        assert rows_of(got.toArrow()) == rows_of(con.execute(queries.ORACLES[name]).to_arrow_table())


def test_digest_columns(spark, sf, given_rows):
    got = {r.doc_id: r for r in queries.op7(spark, sf).collect()}
    for key, text in given_rows:
        ids = ids_of(text)
        assert (got[key].n_tokens, got[key].ids_sha256) == (len(ids), hashlib.sha256(plain.u32(ids)).hexdigest())
        assert got[key].decoded_sha256 == plain.sha(TOKENIZER.decode(ids, skip_special_tokens=False))
    for r in queries.op1(spark, sf).collect():
        assert r.ids_crc32 == plain.crc([*ids_of(dict(given_rows)[r.doc_id]), 0])
    for r in queries.op5(spark, sf).collect():
        ids = [*ids_of(dict(given_rows)[r.doc_id]), 0]
        assert r.ids_crc32 == plain.crc(ids[r.start : r.start + r.length]) and r.doc_tokens == len(ids)
