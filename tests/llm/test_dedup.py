"""SimHash, suffix and line dedup against brute force."""

import hashlib
from collections import Counter

import duckdb
import pytest
import xxhash

from virotide.llm import linededup, simhash, suffixes
from virotide.llm.queries import LLM_ORACLES, LLM_QUERIES

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs_of(spark, texts, extra=()):
    rows = [(i, t, "en", "s", None) for i, t in texts]
    out = spark.createDataFrame(rows, DOCS)
    for name in extra:
        out = out.selectExpr("*", f"doc_id AS `{name}`")
    return out


def tables(spark, name):
    return spark.read.parquet(f"{SF}/{name}.parquet")


def slow_simhash(text):
    words, word = [], ""
    for c in text or "":
        if c == " " or "\t" <= c <= "\r":
            words += [word] if word else []
            word = ""
        else:
            word += chr(ord(c) + 32) if "A" <= c <= "Z" else c
    words += [word] if word else []
    if not words:
        return 0
    parts = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(prints, most=3):
    ids = sorted(prints)
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in ids:
        for b in ids:
            if a < b and (prints[a] ^ prints[b]).bit_count() <= most:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def test_simhash_of_documents(spark):
    texts = {r.doc_id: r.text for r in tables(spark, "documents").collect()}
    prints = {i: slow_simhash(t) for i, t in texts.items()}
    roots = slow_components(prints)
    got = {r.doc_id: (int(r.fingerprint, 16), r.component_id) for r in LLM_QUERIES["op1_simhash"](spark, SF).collect()}
    assert got == {i: (prints[i], roots[i]) for i in texts}


def test_links_find_every_pair(spark):
    import random

    random.seed(3)
    base = [random.getrandbits(64) for _ in range(6)]
    values = set(base)
    for b in base:
        for n in (1, 2, 3, 4):
            for _ in range(12):
                values.add(b ^ sum(1 << k for k in random.sample(range(64), n)))
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    got = {frozenset((r.u, r.v)) for r in simhash.links(spark.createDataFrame([(v,) for v in signed], "fp long")).collect()}
    mask = (1 << 64) - 1
    want = {frozenset((a, b)) for a in signed for b in signed if a < b and ((a ^ b) & mask).bit_count() <= 3}
    assert got == want


def test_simhash_cases(spark):
    texts = [(5, None), (3, ""), (4, " \n"), (9, "one two"), (8, "ONE  two"), (None, "one two"), (7, "x y z"), (7, "x y z")]
    got = Counter((r.doc_id, r.component_id) for r in simhash.near_duplicates(docs_of(spark, texts, ["fp", "component_id"])).collect())
    want = Counter([(5, 3), (3, 3), (4, 3), (9, 8), (8, 8), (None, 8), (7, 7), (7, 7)])
    assert got == want
    kept = simhash.one_of_each(docs_of(spark, texts, ["fp"]))
    assert sorted(r.doc_id for r in kept.collect()) == [3, 7, 8]
    assert kept.columns == [*DOCS.replace(" long", "").replace(" string", "").split(", "), "fp"]
    unnamed = simhash.one_of_each(docs_of(spark, [(None, "one text"), (None, "another one"), (None, "one text"), (3, "third text here"), (3, "and yet another")]))
    assert sorted(r.text for r in unnamed.collect()) == ["and yet another", "another one", "one text", "third text here"]
    assert simhash.near_duplicates(docs_of(spark, [])).count() == 0
    assert [r.component_id for r in simhash.near_duplicates(docs_of(spark, [(None, "a")])).collect()] == [None]


def slow_cut(texts, least, keep_first):
    """Row by row: bytes covered by strings that start elsewhere (earlier, if the first one stays)."""
    seen = Counter()
    first = {}
    for row, t in enumerate(texts):
        for s in range(len(t) - least + 1):
            seen[t[s : s + least]] += 1
            first.setdefault(t[s : s + least], (row, s))
    out = []
    for row, t in enumerate(texts):
        gone = [False] * len(t)
        for s in range(len(t) - least + 1):
            w = t[s : s + least]
            if (first[w] != (row, s)) if keep_first else seen[w] > 1:
                gone[s : s + least] = [True] * least
        out.append((len(t), sum(gone), sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone)), bytes(b for b, g in zip(t, gone, strict=True) if not g)))
    return out


def test_suffixes_of_documents(spark):
    rows = sorted((r.doc_id, (r.text or "").encode()) for r in tables(spark, "documents").collect())
    want = slow_cut([t for _, t in rows], 200, False)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in LLM_QUERIES["op2_suffixes"](spark, SF).collect()}
    assert got == {i: (*w[:3], hashlib.sha256(w[3]).hexdigest()) for (i, _), w in zip(rows, want, strict=True)}


@pytest.mark.parametrize("keep_first", [True, False])
@pytest.mark.parametrize("most_contexts", [4096, 1])
def test_suffixes_small(spark, keep_first, most_contexts, monkeypatch):
    import random

    random.seed(11)
    word = lambda n: "".join(random.choices("abcdé \0", k=n))
    shared, other = word(90), word(70)
    texts = [word(50) + shared + word(40), shared, "", word(30), shared + other + shared[:60], other + word(10) + other, "a" * 150, "ab" * 60, "é" * 40]
    texts += [shared[5:80] + word(20), word(20) + shared[20:], word(3) + "a" * 60]
    frame = docs_of(spark, list(enumerate(texts)), ["start", "removed"])
    out = suffixes.cut_repeats(frame, 48, keep_first, most_contexts).orderBy("doc_id").collect()
    got = [(r.n_bytes, sum(s.stop - s.start for s in r.removed), len(r.removed), bytes(r.kept)) for r in out]
    assert got == slow_cut([t.encode() for t in texts], 48, keep_first)


def test_suffix_slices(spark, monkeypatch):
    import numpy as np

    data = np.frombuffer(bytes(np.random.default_rng(5).integers(97, 101, 3000, dtype=np.uint8)), dtype=np.uint8)
    whole = suffixes.anchors(data, 64)
    monkeypatch.setattr(suffixes, "SLICE", 500)
    cut = suffixes.anchors(data, 64)
    assert whole[3].sum() == cut[3].sum() == 3000 - 64 + 1
    cover = lambda x: {int(s) + k: int(a) for a, s, n in zip(x[0], x[2], x[3], strict=True) for k in range(n)}
    assert cover(whole) == cover(cut)


def test_suffix_cases(spark):
    same = "z" * 10 + "Some long enough text, number one. " * 9
    out = suffixes.cut_repeats(docs_of(spark, [(1, same), (1, same), (None, same), (2, None)]), 200, False).collect()
    assert sorted((str(r.doc_id), r.n_bytes, bytes(r.kept)) for r in out) == sorted([("1", len(same), b""), ("1", len(same), b""), ("None", len(same), b""), ("2", 0, b"")])
    assert suffixes.cut_repeats(docs_of(spark, [])).count() == 0


def test_factors():
    import numpy as np

    text = b"abaabababaabbaabab"
    order = sorted(range(len(text)), key=lambda i: text[i:])

    def common(i, j):
        n = 0
        while max(i, j) + n < len(text) and text[i + n] == text[j + n]:
            n += 1
        return n

    lcp = np.array([0] + [common(a, b) for a, b in zip(order, order[1:], strict=False)])
    got = suffixes.factors(np.array(order), lcp)
    assert list(got) == [max([common(i, j) for j in range(i)], default=0) for i in order]


def test_line_dedup_of_documents(spark):
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = db.execute(LLM_ORACLES["op9_linededup"])
    names = [d[0] for d in want.description]
    got = Counter(tuple(r) for r in LLM_QUERIES["op9_linededup"](spark, SF).select(*names).collect())
    assert got == Counter(want.fetchall())


def test_line_dedup_cases(spark):
    block = "\n".join(f"line {i} of a shared block" for i in range(40))
    texts = [(1, "start\n" + block + "\nend"), (2, "other start\n" + block), (3, None), (4, ""), (5, "x\n\nx"), (None, block), (2, "other start\n" + block)]
    frame = docs_of(spark, texts, ["chunk", "hash"])
    out = linededup.remove_repeats(frame)
    assert out.columns == frame.columns
    got = {}
    for r in out.collect():
        got.setdefault(r.doc_id, []).append(r.text)
    assert got[1] == [texts[0][1]] and got[3] == [None] and got[4] == [""] and got[5] == ["x\n\nx"]
    assert len(got[2]) == 2 and got[2][0] == got[2][1] and len(got[2][0]) < len(block) / 2
    assert len(got[None][0]) < len(block) / 2
    assert linededup.remove_repeats(docs_of(spark, [])).count() == 0


def test_line_boundaries_shift(spark):
    block = [f"line {i}" for i in range(60)]
    frame = docs_of(spark, [(1, "\n".join(block)), (2, "\n".join(["new", *block]))])
    found = {}
    for r in linededup.chunks(frame).collect():
        found.setdefault(r._id, set()).add(r.chunk)
    assert len(found[1] & found[2]) >= len(found[1]) - 2


def test_no_python_in_native_operators(spark):
    for name in ("op8_mixing", "op9_linededup"):
        plan = LLM_QUERIES[name](spark, SF)._jdf.queryExecution().toString()
        assert not any(x in plan for x in ("Python", "Pandas", "Arrow")), name
