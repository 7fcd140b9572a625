"""Personal data: base spans against the plain patterns, and the bootstrapping against brute force."""

import hashlib
import random
import re
import time
from collections import Counter, defaultdict

import fixtures_llm as X
import pytest
from fixtures_llm import SF_SMALL, odd  # noqa: F401

from clickfeat.llm import bootstrap as B
from clickfeat.llm import queries as Q

PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def _luhn(digits):
    return sum(int(c) if k % 2 == 0 else sum(divmod(2 * int(c), 10)) for k, c in enumerate(reversed(digits))) % 10 == 0


def _fits(kind, text):
    digits = re.sub("[^0-9]", "", text)
    return {"email": lambda: True, "ip": lambda: all(int(x) <= 255 for x in text.split(".")),
            "card": lambda: 16 <= len(digits) <= 19 and _luhn(digits), "phone": lambda: 8 <= len(digits) <= 15}[kind]()


def base(text):
    return [(k, m.start(), m.end()) for k, p in PLAIN.items() for m in re.finditer(p, text or "") if _fits(k, m[0])]


def listed(spans):
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def report(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r["doc_id"]: r for r in B.private_report(df).collect()}


def check_base(got, texts):
    for i, t in enumerate(texts):
        want = base(t)
        assert [got[i][f"n_{k}"] for k in PLAIN] == [sum(x[0] == k for x in want) for k in PLAIN], t
        assert got[i]["base_sha256"] == hashlib.sha256(listed(want).encode()).hexdigest(), t
        assert got[i]["spans"].startswith(listed(want)), t


def test_base_spans_of_dense_random_texts(spark):
    rng = random.Random(1)
    # Half of the cards are right ones.
    def card():
        head = "".join(rng.choices("0123456789", k=rng.choice([15, 16, 17, 18])))
        last = next(c for c in "0123456789" if _luhn(head + c))
        return rng.choice([" ", "-", ""]).join((head + rng.choice([last, last, "7"]))[k:k + 4] for k in range(0, 20, 4)).strip(" -")
    pieces = ["@", ".", "a", "B7", "-", "+", " ", "  ", "(", ")", "%", "_", "é", "\U0001f600", "\n", "1", "25", "255", "256", "0007", "x.y", "a@b.c", "1.2.3.4",
              "+4412345678", "a@b.c@d.e", "a@b.c_d@e.f"]
    texts = ["".join(rng.choice(pieces) if rng.random() < 0.95 else card() for _ in range(rng.randrange(60))) for _ in range(1500)] + [None, ""]
    check_base(report(spark, texts), texts)


def test_base_spans_of_the_given_documents(spark):
    rows = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    got = {r["doc_id"]: r for r in Q.op12_bootstrap(spark, SF_SMALL).collect()}
    assert len(got) == len(rows)
    for r in rows:
        assert got[r["doc_id"]]["base_sha256"] == hashlib.sha256(listed(base(r["text"])).encode()).hexdigest()


def test_long_runs_are_scanned_whole_in_linear_time(spark):
    n = 200_000
    texts = ["7" * n, "1 " * n, "a." * n + "@", "a@b" + ".c" * n, "+1" + " (" * n + "2", "1." * n, "@" * n, "a@" * n, "x" * n + "@y.z", "-._/" * n,
             "word " * n + "me@here.org " + "9" * 5]
    began = time.time()
    got = report(spark, texts)
    assert time.time() - began < 120
    assert [got[i]["n_email"] for i in range(len(texts))] == [0, 0, 0, 1, 0, 0, 0, 0, 1, 0, 1]
    assert got[3]["spans"] == f"email:0:{3 + 2 * n}" and got[8]["spans"] == f"email:0:{n + 4}"
    # Four numbers each, as many as fit.
    assert got[5]["n_ip"] == n // 4


def test_contexts_of_known_entities_find_unseen_identifiers(spark):
    seeds = [f"Please phone: +1 (20{k}) 555-010{k} at once." for k in range(4)]
    unseen = ["phone: 555-0188-77, thanks", "his phone: 0800123456", "version 2.0.1234567 of it", "order 99887766 was sent", "the 12345678 of them"]
    # A second round: "fax" follows known values only once these are known.
    second = [f"fax {v}" for v in ("555-0188-77", "0800123456", "+1 (202) 555-0102")] + ["Fax 4433-2211"]
    texts = seeds + unseen + second + ["the word the word"]
    got = report(spark, texts)
    added = {i: [texts[i][int(a):int(b)] for k, a, b in (x.split(":") for x in r["spans"].split(",") if x) if k == "id"] for i, r in got.items()}
    assert added[4] == ["555-0188-77"] and added[5] == ["0800123456"]
    assert added[6] == added[7] == added[8] == []
    assert added[9] == ["555-0188-77"] and added[12] == ["4433-2211"]
    check_base(got, texts)
    one = B.private_report(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), rounds=1)
    assert {r["doc_id"]: r["n_added"] for r in one.collect()}[12] == 0


def brute(texts, rounds=B.ROUNDS):
    """The added spans, from the module's definitions alone."""
    spots, corpus = [], Counter()
    for i, t in enumerate(texts):
        t = t or ""
        words = re.findall(r"[^\W\d_]+", t.lower())
        corpus.update(words)
        corpus.update(f"{a} {b}" for a, b in zip(words, words[1:], strict=False))
        known = base(t)
        runs = [(B.ADDED, m.start() + len(m[0]) - len(m[0].lstrip("@._/+-")), m.end() - len(m[0]) + len(m[0].rstrip("@._/+-")), m.start(), m.end())
                for m in re.finditer(r"[A-Za-z0-9@._/+-]+", t) if re.search("[0-9]", m[0])]
        every = defaultdict(list)
        for k, p in PLAIN.items():
            every[k] = [(m.start(), m.end()) for m in re.finditer(p, t)]
        every[B.ADDED] = [r[3:] for r in runs]
        found = [(k, s, e, s, e) for k, s, e in known]
        found += [r for r in runs if 6 <= r[2] - r[1] <= 64 and len(re.sub("[^0-9]", "", t[r[1]:r[2]])) >= 4
                  and not any(s < r[2] and r[1] < e for _, s, e in known)]
        for k, s, e, lo, _ in found:
            before = max([b for _, b in every[k] if b <= lo], default=0)
            near = re.findall(r"[^\W\d_]+", t[max(before, lo - B.CONTEXT):lo].lower())[-2:]
            patterns = [near[-1], " ".join(near)][:len(near)] if near else []
            spots.append((i, k, s, e, t[s:e].lower(), patterns))
    edges = Counter((p, v) for *_, v, ps in spots for p in ps)
    seeds = {v for _, k, _, _, v, _ in spots if k != B.ADDED}
    values = defaultdict(set)
    for p, v in edges:
        values[p].add(v)
    graph = {p: vs for p, vs in values.items() if len(vs) >= B.LEAST_VALUES}
    seeded = {(p, v) for _, k, _, _, v, ps in spots if k != B.ADDED for p in ps}
    worth = defaultdict(int, {v: 1_000_000 for p, v in seeded if p in graph})
    for _ in range(rounds):
        score = {p: sum(edges[p, v] * worth[v] for v in vs) // max(corpus[p], sum(edges[p, v] for v in vs), 1) for p, vs in graph.items()}
        support = {p: sum(worth[v] >= B.LEAST_SCORE for v in vs) for p, vs in graph.items()}
        trusted = {p for p in graph if support[p] >= B.LEAST_VALUES}
        final = {p for p in trusted if score[p] >= B.LEAST_SCORE}
        worth = defaultdict(int, {v: max([1_000_000 if (p, v) in seeded else score[p] if p in trusted else 0 for p in graph if v in graph[p]], default=0)
                                  for vs in graph.values() for v in vs})
    out = {i: [] for i in range(len(texts))}
    for i, k, s, e, _, ps in spots:
        if k == B.ADDED and set(ps) & final:
            out[i].append((s, e))
    return {i: sorted(set(x)) for i, x in out.items()}


@pytest.mark.parametrize("seed", [2, 3, 4])
def test_added_spans_equal_brute_force(spark, seed):
    rng = random.Random(seed)
    seeds = [f"u{k}@mail{k % 3}.org" for k in range(9)] + [f"10.0.{k}.7" for k in range(9)] + [f"+49 30 12345{k}0" for k in range(9)]
    loose = [f"ab-{k}{k}{k}{k}x" for k in range(1, 9)] + [f"44{k}-99{k}" for k in range(9)] + ["12ab34cd", "x1", "v2.0", "9" * 70]
    words = ["mail", "host", "tel", "konto", "the", "of", "naïve", "Straße", "id"]
    texts = []
    for _ in range(120):
        parts = []
        for _ in range(rng.randrange(1, 12)):
            if rng.random() < 0.4:
                parts.append(rng.choice(words))
            else:
                kind = rng.choice(["mail", "host", "tel", "konto", "the", "my id"])
                pool = {"mail": seeds[:9], "host": seeds[9:18], "tel": seeds[18:]}.get(kind, loose)
                parts.append(f"{kind}{rng.choice([' ', ': ', '=', ' - '])}{rng.choice(pool if rng.random() < 0.8 else seeds + loose)}")
        texts.append(rng.choice([" ", ", ", "\n"]).join(parts))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: sorted((s["start"], s["end"]) for s in r["spans"] if s["kind"] == B.ADDED) for r in B.personal_data(df).collect()}
    want = brute(texts)
    assert sum(map(len, want.values())) > 5 and got == want


def test_odd_tables(spark, odd):
    rows = Q.op12_bootstrap(spark, odd).collect()
    texts = {r[0]: r[1] for r in X.documents()}
    for r in rows:
        assert r["base_sha256"] == hashlib.sha256(listed(base(texts[r["doc_id"]])).encode()).hexdigest()
