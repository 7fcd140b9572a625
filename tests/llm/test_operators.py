"""The operators against brute force on the driver's small tables."""

import random
from pathlib import Path

import duckdb
import fixtures_llm as X
import numpy as np
import pyarrow as pa
import pytest
from fixtures_llm import SF_SMALL

from clickfeat.llm import forest, jaccard, lattice, mixing, pieces, secrets, spans, topk, toxicity, wrappers
from clickfeat.llm import queries as Q
from clickfeat.llm.common import words


@pytest.fixture(scope="module")
def docs():
    return duckdb.sql(f"SELECT doc_id, text FROM '{SF_SMALL}/documents.parquet' ORDER BY 1").fetchall()


@pytest.mark.parametrize("name", sorted(Q.oracle_sql()))
def test_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "labels", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_SMALL}/{t}.parquet'")
    want = con.execute(Q.oracle_sql()[name]).df()
    got = Q.catalogue()[name](spark, SF_SMALL).toPandas()[list(want.columns)]
    order = list(want.columns)
    assert got.sort_values(order).astype(str).values.tolist() == want.sort_values(order).astype(str).values.tolist()


def test_spans(spark, docs):
    got = {r["doc_id"]: (r["n_sentences"], r["n_removed"]) for r in Q.op1_spans(spark, SF_SMALL).collect()}
    assert got == X.repeated_sentences(docs)


def test_spans_cut_text(spark):
    rows = spark.createDataFrame([(1, X.PASSAGE), (2, f"Own words. {X.PASSAGE} Own end.")], "doc_id long, text string")
    assert {r["doc_id"]: r["text"] for r in spans.without_repeats(rows).collect()} == {1: X.PASSAGE, 2: "Own words.  Own end."}


def test_spans_cut_overlong_sentences(spark):
    """Copies and passages of one long sentence go; the first copy and other words stay."""
    rng = random.Random(3)
    some = lambda n: [f"w{rng.randrange(5000)}" for _ in range(n)]
    whole, passage = " ".join(some(60)), some(50)
    docs = [(1, whole), (2, whole), (3, " ".join(some(30) + passage + some(25))), (4, " ".join(some(41) + passage + some(9))),
            (5, "the " * 100)]
    got = {r["doc_id"]: r["text"].split() for r in spans.without_repeats(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got[1] == docs[0][1].split() and got[3] == docs[2][1].split() and got[2] == []
    assert len(got[4]) <= 100 - 12 and got[4][:41] == docs[3][1].split()[:41] and got[4][-9:] == docs[3][1].split()[-9:]
    assert 12 <= len(got[5]) <= 24
    report = {r["doc_id"]: r for r in spans.span_report(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert report[2]["removed"] == f"0:{len(whole)}" and report[2]["n_sentences"] == 1 and report[1]["removed"] == ""


def test_every_shared_passage_of_fifty_words_holds_a_span():
    rng = random.Random(4)
    for stops in (0.0, 0.02, 0.05, 0.2):
        for _ in range(200):
            text = lambda n: [f"w{rng.randrange(300)}" + "." * (rng.random() < stops) for _ in range(n)]
            passage = text(50)
            pair = [" ".join(text(rng.randrange(60)) + passage + text(rng.randrange(60))).encode() for _ in range(2)]
            a, b = spans.sentence_spans(pair)
            assert set(a[4].tolist()) & set(b[4].tolist())


def test_mixture_fills_siblings_first(spark):
    rows = spark.createDataFrame(
        [("a", "x", 10, 10), ("a", "y", 10, 100), ("b", "z", 1, 500)], "domain string, lang string, w int, supply long")
    parents = spark.createDataFrame([("a", 60), ("b", 40)], "domain string, budget long")
    got = {r["lang"]: r["budget"] for r in mixing.dealt(rows, parents, ["domain"]).collect()}
    assert got == {"x": 10, "y": 50, "z": 40}


def test_base_scores(spark, docs):
    want = X.base_scores(docs)
    for r in Q.op3_lattice(spark, SF_SMALL).collect():
        held, n, known, total, base = want[r["doc_id"]]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held, n, known, total)
        assert r["base_score"] == pytest.approx(base, abs=1e-6 * max(1, abs(base)))
        assert np.isfinite(r["score"]) and r["score"] < 0


VOCABULARY = pieces.Vocabulary(
    ["<unk>", *[f"<0x{b:02X}>" for b in range(256)], "▁", "a", "b", "ab", "▁a", "ba", "▁ab"],
    [0.0, *[0.0] * 256, -3.0, -2.0, -2.5, -3.0, -1.5, -2.2, -4.0], "x" + "b" * 256 + "p" * 7)


def _segmentations(s):
    if not s:
        yield ()
    for n in (1, 2, 3):
        if s[:n] in VOCABULARY.pieces[257:] and len(s) >= n:
            for rest in _segmentations(s[n:]):
                yield (s[:n], *rest)


def test_lattice_sums_all_segmentations():
    w = lattice._logs(np.exp(np.array(VOCABULARY.scores))[:, None].repeat(2, 1) * np.array([[1.0, 2.0]]))
    model = lattice.Lattice(VOCABULARY, w)
    batch = [b"abab", b"a", b"bba", b"aabba"]
    model.take(batch)
    got = model.marginals()
    at = {p: i for i, p in enumerate(VOCABULARY.pieces)}
    for word, row in zip(batch, got, strict=True):
        want = np.logaddexp.reduce([sum(w[at[p], 0] for p in seg) for seg in _segmentations("▁" + word.decode())])
        assert row[0] == pytest.approx(want)
    counts = model.expected(np.ones((4, 2)))
    spelled = sum(counts[i, 0] * len(p) for i, p in enumerate(VOCABULARY.pieces))
    assert spelled == pytest.approx(sum(len(x) + 1 for x in batch))


def test_lattice_runs_three_rounds():
    assert lattice.ROUNDS == 3


def test_lattice_takes_only_long_words_in_log_space(monkeypatch):
    """Words whose probability leaves the range of a double, beside others, which take no logarithm an edge."""
    w = lattice._logs(np.exp(np.array(VOCABULARY.scores))[:, None].repeat(2, 1) * np.array([[1.0, 2.0]]))
    model = lattice.Lattice(VOCABULARY, w)
    in_logs, plain = [], lattice.Lattice._sweep

    def sweep(self, terms, *rest):
        if (terms < 0).any():
            in_logs.append(len(self.first))
        return plain(self, terms, *rest)

    monkeypatch.setattr(lattice.Lattice, "_sweep", sweep)
    model.take([b"abab", "☃".encode() * 300, b"a"])
    at = {p: i for i, p in enumerate(VOCABULARY.pieces)}
    got = model.marginals()[:, 0]
    snowman = sum(w[at[f"<0x{b:02X}>"], 0] for b in "☃".encode())
    assert got[1] == pytest.approx(w[at["▁"], 0] + 300 * snowman) and got[1] < -1000
    for k, word in ((0, "abab"), (2, "a")):
        assert got[k] == pytest.approx(np.logaddexp.reduce([sum(w[at[p], 0] for p in seg) for seg in _segmentations("▁" + word)]))
    counts = model.expected(np.array([[True, False], [True, True], [False, True]]))
    assert [counts[at[f"<0x{b:02X}>"], k] for b in "☃".encode() for k in (0, 1)] == pytest.approx([300.0] * 6)
    spelled = [sum(counts[i, k] * len(p) for i, p in enumerate(VOCABULARY.pieces) if i > 256) for k in (0, 1)]
    assert spelled == pytest.approx([6.0, 3.0])
    assert in_logs == [1, 2, 2]     # one word's marginal; forward and back, the long word in both classes


@pytest.mark.parametrize("most", [1, 7, 1 << 21])
def test_lattice_cuts_the_same_words(monkeypatch, most):
    monkeypatch.setattr(lattice, "AT_ONCE", most)
    texts = [b"", None, b" a  B ", bytes(range(1, 128)), "É ÀB c x\x85y\x1cZ\xa0  q".encode(), b"\x00 a\x00b\n", b"\n", b"x" * 300, None]
    column = pa.array([t and t.decode() for t in texts], pa.string())
    got = [[] for _ in texts]
    for lo, hi, own, code, row in lattice._cut(column):
        assert len(set(own.to_pylist())) == len(own) and (row < hi - lo).all()
        for c, r in zip(code.tolist(), row.tolist(), strict=True):
            got[lo + r].append(own[c].as_py())
    assert got == [words(t) for t in texts]


def test_lattice_is_a_distribution():
    """All words of up to seven letters, and what is longer, have probability below one in all."""
    w = lattice._logs(np.exp(np.array(VOCABULARY.scores))[:, None])
    model = lattice.Lattice(VOCABULARY, w)
    words = [b""]
    total = 0.0
    for _ in range(7):
        words = [x + c for x in words for c in (b"a", b"b")]
        model.take(words)
        total += float(np.exp(model.marginals()).sum())
    assert 0.0 < total < 1.0


def test_pieces_are_the_librarys():
    """Known characters and single spaces: as good a path as the best of the library's own lattice."""
    sentencepiece = pytest.importorskip("sentencepiece")
    proto = pytest.importorskip("sentencepiece.sentencepiece_model_pb2")
    m = proto.ModelProto()
    m.ParseFromString(open(pieces.MODEL, "rb").read())
    m.trainer_spec.model_type = 1
    own = sentencepiece.SentencePieceProcessor(model_proto=m.SerializeToString())
    p = pieces.Pieces(pieces.load_vocabulary())
    texts = ["the thing of it", "einen Schaden", "la nación está aquí", "word", "unbelievably long compoundwordsthatrun"]
    for text, ids in zip(texts, p.encode(texts), strict=True):
        best = own.nbest_encode(text, nbest_size=2)[0]
        score = lambda x: sum(own.get_score(int(i)) for i in x)
        assert own.decode(np.frombuffer(ids, "<i4").tolist()) == text
        assert score(np.frombuffer(ids, "<i4")) == score(best)


def test_pieces_take_the_best_path():
    p = pieces.Pieces(VOCABULARY)
    score = dict(zip(VOCABULARY.pieces, VOCABULARY.scores, strict=True))
    rng = random.Random(3)
    for _ in range(50):
        s = "".join(rng.choice("ab") for _ in range(rng.randint(1, 9)))
        got = np.frombuffer(p.encode([s])[0], "<i4")
        best = max(sum(score[x] for x in seg) for seg in _segmentations("▁" + s))
        assert sum(VOCABULARY.scores[i] for i in got) == pytest.approx(best)


@pytest.mark.parametrize("text", ["", " ", "a  b", "\n\n", "▁▁ a", "日本 ☃\x00 z", "é" * 50, "a" * 3000, "tab\tx "])
def test_pieces_round_trip(text):
    p = pieces.Pieces(pieces.load_vocabulary())
    ids = np.frombuffer(p.encode([text])[0], "<i4")
    assert p.decode(ids, np.array([0, len(ids)])) == [text]


def test_pieces_keep_common_words_when_the_memory_turns_over(monkeypatch):
    monkeypatch.setattr(pieces, "KEPT_BYTES", 8000)
    p = pieces.Pieces(VOCABULARY)
    met, plain = [], p.viterbi
    monkeypatch.setattr(p, "viterbi", lambda marked: met.extend(marked) or plain(marked))
    fresh = pieces.Pieces(VOCABULARY)
    for k in range(20):
        text = "ab " + " ".join("a" * i + "b" * (k + 1) for i in range(1, 10))
        assert p.encode([text]) == fresh.encode([text])
        assert len(p.kept) < 60
    assert met.count("▁ab") == 1 and len(met) > 150


def test_edges_are_all_pieces_of_a_word():
    words = ["▁ab☃ba", "▁", "", "▁b\x00", "▁aabba"]
    g = pieces.Edges(VOCABULARY)
    g.load(words)
    got = {(w, i, j, r) for w, i, j, r in zip(g.word.tolist(), g.from_at.tolist(), g.to_at.tolist(), g.row.tolist(), strict=True) if r < g.size}
    assert got == {(k, i, j, VOCABULARY.pieces.index(w[i:j], 257)) for k, w in enumerate(words) for i in range(len(w))
                   for j in range(i + 1, len(w) + 1) if w[i:j] in VOCABULARY.pieces[257:]}
    assert len(g.row) - len(got) == len(g.spelled) == 2


def test_jaccard(spark, docs):
    sizes, comp = X.jaccard_components(docs)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in Q.op5_jaccard(spark, SF_SMALL).collect()}
    assert got == {i: (sizes[i], comp[i]) for i in sizes}


def test_jaccard_large_groups(spark, monkeypatch):
    """Groups past the thresholds of frequent shingles and slices, with chains of links."""
    monkeypatch.setattr(jaccard, "FREQUENT", 4)
    monkeypatch.setattr(jaccard, "SLICE", 8)
    rng = random.Random(5)
    base = [f"w{rng.randint(0, 400)}" for _ in range(150)]
    rows = []
    for i in range(60):
        w = list(base)
        for _ in range(i % 4):
            w[rng.randint(0, 149)] = f"x{i}{rng.randint(0, 9)}"
        rows.append((i, " ".join(w)))
    for i in range(60, 90):     # each shares most with the next
        w = list(base)
        w[5 * (i - 60):5 * (i - 60) + 3] = ["y"] * 3
        rows.append((i, " ".join(w)))
    rows += [(90 + i, " ".join(base[:40] + [f"z{i}-{k}" for k in range(60)])) for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.similarity_report(df).collect()}
    sizes, comp = X.jaccard_components(rows)
    assert got == {i: (sizes[i], comp[i]) for i in sizes}


def test_jaccard_keeps_less_than_the_texts(spark, monkeypatch):
    """No table holds the sets of all documents, which are larger than their texts."""
    sizes, plain, rng = [], jaccard.stored, random.Random(5)

    def stored(df, name):
        out = plain(df, name)
        sizes.append(sum(f.stat().st_size for f in Path(out.folder.removeprefix("file:")).rglob("*.parquet")))
        return out
    monkeypatch.setattr(jaccard, "stored", stored)
    texts = [" ".join("".join(rng.choices("abcdefgh", k=4)) for _ in range(2000)) for _ in range(300)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(300, texts[7]), (301, texts[8] + " z"), (302, None)]
    got = {r["doc_id"]: r for r in jaccard.similarity_report(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()}
    assert {k: r["component_id"] for k, r in got.items()} == {i: i for i in range(300)} | {300: 7, 301: 8, 302: 302}
    assert got[301]["n_shingles"] == len(set(zip(*[(texts[8] + " z").split()[j:] for j in range(5)], strict=False)))
    assert sizes and sum(sizes) < sum(map(len, texts)) / 2


def test_tree_bound_keeps_all_similar_pairs():
    rng = np.random.default_rng(1)
    sets = [set(rng.integers(0, 60, rng.integers(5, 50)).tolist()) for _ in range(200)]
    sets += [s ^ {int(rng.integers(0, 60))} for s in sets[:80]]
    sizes = np.array([max(1, len(s)) for s in sets])
    points = [np.bincount([x % jaccard.groups_of(int(n)) for x in s], minlength=jaccard.groups_of(int(n))).astype("<u2")
              for s, n in zip(sets, sizes, strict=True)]
    ids = np.arange(len(sets))
    got = {(max(p), min(p)) for a, b in jaccard.tree_join(ids, sizes, points) for p in zip(a.tolist(), b.tolist(), strict=True)}
    want = {(a, b) for a in ids.tolist() for b in range(a) if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])}
    assert want <= got
    half = [(a[:140], b[140:]) for a, b in ((ids, ids),)][0]
    across = {(max(p), min(p)) for a, b in jaccard.tree_join(half[0], sizes[:140], points[:140], other=(half[1], sizes[140:], points[140:]))
              for p in zip(a.tolist(), b.tolist(), strict=True)}
    assert {p for p in want if (p[0] < 140) != (p[1] < 140)} <= across


def _vectors(spark):
    rng = np.random.default_rng(2)
    x = rng.standard_normal((1500, 24))
    near = x[:400] + 0.08 * rng.standard_normal((400, 24))
    chain = x[:200] + 0.3 * rng.standard_normal((200, 24))
    ball = x[7] + 0.05 * rng.standard_normal((500, 24))
    v = np.vstack([x, near, chain, ball])
    return v, spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(v)], "vec_id long, embedding array<double>")


@pytest.mark.parametrize("leaf", [512, 32])
def test_forest_recall(spark, monkeypatch, leaf):
    monkeypatch.setattr(forest, "LEAF", leaf)
    monkeypatch.setattr(forest, "LEAF_MOST", 4 * leaf if leaf > 100 else 40)
    v, df = _vectors(spark)
    u = X.unit(v)
    near = u @ u.T >= 0.9
    degree = near.sum(1) - 1
    got = {r["vec_id"]: r for r in forest.near_vectors(df).collect()}
    links = np.array([got[i]["n_links"] for i in range(len(v))])
    assert (links <= degree).all()
    assert links.sum() >= 0.9 * degree.sum()
    want = X.linked(range(len(v)), zip(*np.nonzero(np.triu(near, 1)), strict=True))
    same = sum(got[i]["component_id"] == want[i] for i in range(len(v)))
    assert same >= 0.95 * len(v)


def test_forest_keeps_all_links_of_a_loose_heavy_group(spark, monkeypatch):
    """A group of a third with pair cosines about 0.93: no ball holds it, and no leaf may cut it."""
    monkeypatch.setattr(forest, "LEAF", 64)
    monkeypatch.setattr(forest, "LEAF_MOST", 256)
    monkeypatch.setattr(forest, "SLICE", 300)
    rng = np.random.default_rng(5)
    c = rng.standard_normal(64)
    v = np.vstack([0.93 ** 0.5 * c / np.linalg.norm(c) + 0.07 ** 0.5 * rng.standard_normal((1000, 64)) / 8,
                   rng.standard_normal((2000, 64))])
    u = X.unit(v)
    degree = (u @ u.T >= 0.9).sum(1) - 1
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(v)], "vec_id long, embedding array<double>")
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in forest.near_vectors(df).collect()}
    assert [got[i][0] for i in range(len(v))] == degree.tolist()
    assert {got[i][1] for i in range(1000)} == {0}


def test_topk_ties_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(topk, "QUERY_BLOCK", 40)
    monkeypatch.setattr(topk, "BLOCK_ROWS", 64)
    rng = np.random.default_rng(4)
    v = rng.integers(-2, 3, (700, 3)) / 64.0
    v[100:400] = v[3]
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(v)], "vec_id long, embedding array<double>")
    q = np.floor(64 * v).astype(int)
    got = {}
    for r in topk.top_k(df).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    for i in range(0, 700, 20):
        s = q @ q[i]
        best = [j for j in sorted(range(700), key=lambda j: (-s[j], j)) if j != i][:20]
        assert sorted(got[i]) == [(k + 1, j, int(s[j])) for k, j in enumerate(best)]


def test_toxicity_held_out(spark):
    """Words and beginnings learned on training rows find held-out toxic rows; clean ones stay."""
    rng = random.Random(6)
    syllables = ["ba", "ke", "lo", "mi", "nu", "ra", "so", "ti"]
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randint(1, 4)))
    rows, labels = [], []
    for i in range(1500):
        toxic = i % 6 == 0
        w = [word() for _ in range(60)]
        if toxic:
            for _ in range(4):
                w[rng.randrange(60)] = rng.choice(["awfulword", "vilething", "grim" + word(), "foulmouth"])
        rows.append((i, " ".join(w)))
        labels.append((i, int(toxic)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    got = toxicity.toxicity_report(df, marks).filter("held_out").collect()
    hit = [r["predicted"] for r in got if r["doc_id"] % 6 == 0]
    clean = [r["predicted"] for r in got if r["doc_id"] % 6]
    assert np.mean(hit) >= 0.95 and np.mean(clean) <= 0.02


def test_toxicity_sample_holds_one_row_a_doc_id(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(1, f"text {i}") for i in range(50)] + [(2, "b"), (3, None)], "doc_id long, text string")
    marks = spark.createDataFrame([(1, 0), (2, 1), (3, 0)], "doc_id long, toxic int")
    rows = toxicity.training_rows(df, marks, F.lit(True)).collect()
    assert len(rows) == 3 and {"b", None} < {r["text"] for r in rows}


def test_toxicity_without_toxic_rows(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 0)], "doc_id long, toxic int")
    assert [r["score"] for r in toxicity.toxicity_report(df, labels).collect()] == [0.0, 0.0]


def test_wrapper_has_optional_and_repeated_groups():
    a = wrappers.page_tree("<body><div class=top>x</div><ul><li>a<li>b</ul><p>one<p>two</body>")
    b = wrappers.page_tree("<body><ul><li>c</ul><p>one</p><div class=note>n</div></body>")
    assert wrappers.regular_expression(wrappers.merged(a, b)) == "(body: (div.top: #)? (ul: (li: #)+) (p: #)+ (div.note: #)?)"


def test_wrapper_content_without_article():
    html = ("<html><body><header>Site</header><div id=menu><ul><li>Home</ul></div><div class=wrap><div class=story>"
            + "".join(f"<p>Paragraph {i} of the story &amp; more.</p>" for i in range(8))
            + "<div class=share>Share this</div></div><aside>Side</aside></div><div id=footer>End</div><script>if (a<b) '</p>'</script></body></html>")
    paths = wrappers.content_paths(wrappers.page_tree(html))
    assert wrappers.extract(html, set(paths)) == " ".join(f"Paragraph {i} of the story & more." for i in range(8))


def test_minority_templates_keep_their_text(spark):
    story = lambda i: f"<p>Story {i} with a few words.</p>"
    blog = [f"<body><nav>Menu</nav><article>{story(i)}</article></body>" for i in range(8)]
    shop = ["<body><nav>Menu</nav><div class=item><p>An item for sale</p></div></body>", "just text", "<body><nav>Menu</nav></body>"]
    plain = [f"<body><div class=story>{story(i) * 9}</div></body>" for i in range(8)] + ["<body><section class=old><p>Old page</p></section></body>"]
    pages = [(i, "http://a.example/", h) for i, h in enumerate(blog + shop)] + [(100 + i, "http://b.example/", h) for i, h in enumerate(plain)]
    got = {r["page_id"]: r["text"] for r in wrappers.main_texts(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert got[0] == "Story 0 with a few words."
    assert (got[8], got[9], got[10], got[108]) == ("An item for sale", "just text", "", "Old page")


def test_secret_battery_finds_other_encodings(spark):
    rng = random.Random(8)
    prose = ["".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(3, 22))) for _ in range(4000)]
    rows = [(i, " ".join(prose[20 * i:20 * i + 20])) for i in range(200)]
    upper = "9233A8ECF7C5B09FE5949719B6B82BC439E9329B"
    mixed = "q8Zt2LxVb7RkW0nYp4HsJ6mDfA3cGe5U"
    rows[3] = (3, rows[3][1] + f" key {upper} and")
    rows[7] = (7, f"{mixed} " + rows[7][1])
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r for r in secrets.secret_report(df).collect()}
    found = {i: r["spans"] for i, r in got.items() if r["n_random"]}
    assert found == {3: f"random:{rows[3][1].index(upper)}:{rows[3][1].index(upper) + 40}", 7: "random:0:32"}
    texts = {r["doc_id"]: r["text"] for r in secrets.redact(df).collect()}
    assert upper not in texts[3] and "[SECRET]" in texts[3] and texts[5] == rows[5][1]


def test_secrets_without_a_digit_are_found(spark):
    rng = random.Random(9)
    prose = ["".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(3, 22))) for _ in range(4000)]
    rows = [(i, " ".join(prose[20 * i:20 * i + 20])) for i in range(200)]
    letters = "qQZtLxVbTRkWznYpGHsJvmDfAPcGeXUq"
    rows[7] = (7, f"{letters} " + rows[7][1])
    got = secrets.secret_report(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["spans"] for r in got if r["n_random"]} == {7: "random:0:32"}
    assert secrets.encoding("etaoinshrdluetaoinshrdlu") is None and secrets.encoding("1234567890123456") is None


def test_battery_rejects_order():
    alphabet = secrets.ENCODINGS[0][1]
    assert secrets.battery("0123456789abcdef0123456789abcdef", alphabet) < 0.05
    assert secrets.battery("aaaaaaaaaaaaaaaa1aaaaaaa", alphabet) < secrets.RANDOM_LEVEL
    assert secrets.battery("04dbebab91ab85687d33eeaaf9ac699e", alphabet) > 0.01


def test_edges_of_words():
    e = pieces.Edges(VOCABULARY)
    e.load(["▁ab", "▁z"])
    assert sorted((int(s), int(t)) for s, t in zip(e.start, e.end, strict=True)) == [(0, 1), (0, 2), (0, 3), (1, 2), (1, 3), (2, 3), (4, 5), (5, 6)]


@pytest.mark.parametrize("most", [0, 1, 7, 40, 500, 10_000])
def test_bounded_top_and_sample(spark, most):
    from clickfeat.llm.common import bounded_sample, bounded_top

    rows = spark.range(1000).selectExpr("id", "CAST(1 + (id * id) % 517 AS BIGINT) AS c")
    counts = sorted((r["c"] for r in rows.collect()), reverse=True)
    top = sorted((r["c"] for r in bounded_top(rows, "c", most).collect()), reverse=True)
    assert len(top) <= most and top == counts[:len(top)]
    assert len(top) >= min(most, 1000) * 0.7 or most < 40
    sample = bounded_sample(rows, "id", most).count()
    assert 0.8 * min(most, 1000) <= sample <= most or most < 40


def test_spans_of_hot_hashes(spark, docs, monkeypatch):
    """The way of hot spans gives what the exchange gives."""
    want = X.repeated_sentences(docs)
    df = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    whole = sorted(map(tuple, spans.span_report(df).collect()))
    monkeypatch.setattr(spans, "SAMPLED", 1)
    monkeypatch.setattr(spans, "HOT_ROWS", 2)
    seen = []
    plain = spans._behind_hot
    monkeypatch.setattr(spans, "_behind_hot", lambda rows, hot: seen.append(hot.count()) or plain(rows, hot))
    assert sorted(map(tuple, spans.span_report(df).collect())) == whole and seen[0] > 10
    assert {r[0]: (r[1], r[2]) for r in whole} == want
