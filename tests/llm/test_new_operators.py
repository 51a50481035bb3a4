"""Phrases, token alignment and sharding against brute force and their laws."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from virotide.llm import alignment, phrases, sharding
from virotide.llm.queries import ALIGNED_FILES, LLM_QUERIES

SF = "/root/testdata/sf0.001"
ODD = [
    (None, None), (-1, ""), (-2, " "), (-3, "  two  spaces "), (-4, "\n\tx \n y"), (-5, "<|endoftext|> <s> </s>"), (-6, "a▁b"),
    (-7, "日本語 のテキスト 🙂 é́"), (-8, "x" * 9000), (-9, "don't " * 1500), (-9, "same"), (-9, "same"), (-10, " x 　 y"), (-11, "ﬁ ﷺ z"),
]


# --- phrases ------------------------------------------------------------------------------------------


def brute_phrases(rows, least, top):
    """(lang, rank, phrase, a, l, r, n, score) by counting every phrase as text."""
    counts, totals = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = lang or "und"
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for n in range(1, 6):
                counts[lang].update(" ".join(words[i : i + n]) for i in range(len(words) - n + 1))
    out = []
    for lang, known in counts.items():
        good = {p: a for p, a in known.items() if a >= least and " " in p}
        found = []
        for p, a in good.items():
            w = p.split(" ")
            if any(b >= a and len(o) > len(p) and f" {p} " in f" {o} " for o, b in good.items()):
                continue
            cuts = [(1000 * a * totals[lang] // (known[" ".join(w[:k])] * known[" ".join(w[k:])]), k) for k in range(1, len(w))]
            score, k = min(cuts)
            found.append((-score, -a, p.encode(), p, known[" ".join(w[:k])], known[" ".join(w[k:])]))
        out += [(lang, rank, p, -a, left, right, totals[lang], -s) for rank, (s, a, _, p, left, right) in enumerate(sorted(found)[:top], 1)]
    return sorted(out)


TEXTS = [
    ("en", "The Red Fox, the red fox; the red fox ran. the red fox"), ("en", "a a a a a a\ta  a a!a a"), ("en", None), ("en", ""), (None, "ÄB äb Äb äb ÄB äb"),
    ("und", "ÄB äb"), ("en", "the red fox"), ("en", "the red fox"), ("de", " .,;:!?\n\r"), ("en", "deep blue sea of deep blue sea of deep blue sea"),
]


def mined(spark, rows, least, top, extra=()):
    frame = spark.createDataFrame([(n, lang, text) for n, (lang, text) in enumerate(rows)], "doc_id long, lang string, text string")
    for name in extra:
        frame = frame.selectExpr("*", f"doc_id AS `{name}`")
    return sorted(tuple(r) for r in phrases.collocations(frame, least=least, top=top).drop("first").collect())


def test_phrases_of_small_texts(spark):
    assert mined(spark, TEXTS, 2, 5) == brute_phrases(TEXTS, 2, 5)
    assert mined(spark, TEXTS, 2, 100, ("words", "phrase", "a")) == brute_phrases(TEXTS, 2, 100)
    assert mined(spark, TEXTS[2:4], 1, 5) == []


def test_long_texts_are_worked_through_in_windows(spark, monkeypatch):
    monkeypatch.setattr(phrases, "SLICE", 64)
    rows = [*TEXTS, ("en", "the red fox ran over the deep blue sea " * 20), ("en", "x" * 300 + " red fox")]
    assert mined(spark, rows, 3, 50) == brute_phrases(rows, 3, 50)


def test_equal_fingerprints_are_told_apart(spark, monkeypatch):
    """With one bit of fingerprint nearly all phrases collide; the counts stay those of the texts."""
    monkeypatch.setattr(phrases, "BASE", 1)
    assert mined(spark, TEXTS, 2, 50) == brute_phrases(TEXTS, 2, 50)


def test_first_occurrence(spark):
    frame = spark.createDataFrame([(4, "en", "x red fox"), (2, "en", "a b, red fox"), (9, "en", "red fox")], "doc_id long, lang string, text string")
    (row,) = phrases.collocations(frame, least=3).collect()
    assert (row["phrase"], row["first"]["doc_id"], row["first"]["word"]) == ("red fox", 2, 2)


def test_slices_of_a_task_are_summed_before_they_are_sent(spark, monkeypatch):
    """Small slices, held and sent early alike: the same counts and the same first places, null ids first."""
    monkeypatch.setattr(phrases, "SLICE", 64)
    rows = [(None if i == 7 else 90 - i, lang, text) for i, (lang, text) in enumerate([*TEXTS, *TEXTS, *TEXTS])]
    frame = spark.createDataFrame(rows, "doc_id long, lang string, text string").coalesce(1)
    whole = sorted((tuple(r) for r in phrases.collocations(frame, least=2).collect()), key=str)
    monkeypatch.setattr(phrases, "HELD", 5)
    assert sorted((tuple(r) for r in phrases.collocations(frame, least=2).collect()), key=str) == whole
    assert [r[:8] for r in whole] == sorted(brute_phrases([r[1:] for r in rows], 2, 2000), key=str)


def rows_made(frame):
    """Rows that each MapInArrow of an executed plan gave."""
    todo, found = [frame._jdf.queryExecution().executedPlan()], []
    while todo:
        node = todo.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
        elif "QueryStage" in name:
            todo.append(node.plan())
        elif name == "MapInArrow":
            metrics = node.metrics().iterator()
            pairs = [metrics.next() for _ in range(node.metrics().size())]
            found += [m._2().value() for m in pairs if m._2().name().get() == "number of output rows"]
        todo += [node.children().apply(i) for i in range(node.children().size())]
    return found


def test_phrases_of_all_tasks_travel_as_lists(spark):
    """Eight tasks with the same phrases make no more rows than there are phrases, and the counts are those of all."""
    words = [f"w{i}" for i in range(2000)]
    frame = spark.range(8, numPartitions=8).selectExpr("8 - id AS doc_id", "'en' AS lang", f"'{' '.join(words)}' AS text")
    counts = phrases.phrase_counts(frame, least=8)
    expected = {" ".join(words[i : i + n]): (n, 8, 1, i) for n in range(1, 6) for i in range(len(words) - n + 1)} | {"": (0, 16000, None, None)}
    found = counts.collect()
    assert len(found) == len(expected)
    assert {r["phrase"]: (r["words"], r["a"], *r["first"]) for r in found} == expected
    made = rows_made(counts)
    assert made and max(made) <= len(expected)


def test_phrases_are_listed_by_part_and_language():
    """Long parts are dealt over several rows; the rows give the phrases back, null places too."""
    rows = [(i % 3, "en" if i % 2 else "de", f"p {i}", i, None if i == 4 else i, i) for i in range(42)]
    told = phrases.pa.table(list(zip(*rows, strict=True)), names=phrases.TOLD)
    lists = list(phrases._listed(told, 3))
    assert sum(b.num_rows for b in lists) == 6 * 3 and max(len(x) for b in lists for x in b.column("phrase").to_pylist()) == 3
    back = [tuple(r.values()) for b in lists for r in phrases._spread(b.slice(1)).to_pylist() + phrases._spread(b.slice(0, 1)).to_pylist()]
    assert sorted(back, key=str) == sorted(rows, key=str)


# --- alignment ----------------------------------------------------------------------------------------


def brute_alignment(rows):
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    a_path, b_path = (public_tokenizers.path(n) for n in ALIGNED_FILES)
    model = Tokenizer.from_file(a_path)
    model.encode_special_tokens = True
    pieces = SentencePieceProcessor(model_file=b_path)
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in plain}
    letters |= {chr(256 + n): b for n, b in enumerate(b for b in range(256) if b not in plain)}
    counts, tokens = Counter(), []
    for _, text in rows:
        whole = (" " + (text or "")).encode()
        a = [(i, bytes(letters[c] for c in model.id_to_token(i))) for i in model.encode(" " + (text or ""), add_special_tokens=False).ids]
        b = [(i, bytes([int(pieces.id_to_piece(i)[3:5], 16)]) if pieces.is_byte(i) else pieces.id_to_piece(i).replace("▁", " ").encode()) for i in pieces.encode(text or "")]
        if not text or b"".join(t for _, t in a) != whole or b"".join(t for _, t in b) != whole:
            tokens.append(None)
            continue
        links, groups, i, j = [], [], 0, 0
        a_end, b_end, open_a, open_b = len(a[0][1]), len(b[0][1]), [a[0][0]], [b[0][0]]
        while True:
            links.append((a[i][0], b[j][0]))
            both = a_end == b_end
            if both:
                groups.append(",".join(map(str, open_a)) + "|" + ",".join(map(str, open_b)))
                open_a, open_b = [], []
                if i == len(a) - 1:
                    break
            step_a, step_b = both or a_end < b_end, both or b_end < a_end
            if step_a:
                i += 1
                a_end += len(a[i][1])
                open_a.append(a[i][0])
            if step_b:
                j += 1
                b_end += len(b[j][1])
                open_b.append(b[j][0])
        counts.update(links)
        tokens.append((len(a), len(b), groups, links))
    best = {}
    for (_, b), n in counts.items():
        best[b] = max(best.get(b, 0), n)
    for (doc_id, _), t in zip(rows, tokens, strict=True):
        if t is None:
            yield doc_id, 0, 0, 0, 0, 0, 0, ""
        else:
            n_a, n_b, groups, links = t
            most = sum(counts[k] == best[k[1]] for k in links)
            yield doc_id, n_a, n_b, len(groups), len(links), most, sum(counts[k] for k in links), hashlib.sha256(";".join(groups).encode()).hexdigest()


def aligned(spark, frame):
    return sorted((tuple(r) for r in alignment.align(frame, *(public_tokenizers.path(n) for n in ALIGNED_FILES)).collect()), key=str)


def test_alignment_of_documents(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert sorted((tuple(r) for r in LLM_QUERIES["op12_alignment"](spark, SF).collect()), key=str) == sorted(brute_alignment(rows), key=str)


def test_long_texts_are_folded_from_ranges(spark, monkeypatch):
    monkeypatch.setattr(alignment, "RANGE", 300)
    monkeypatch.setattr(alignment, "BLOCK", 5000)
    frame = spark.createDataFrame([(i, t, i, "b") for i, t in ODD], "doc_id long, text string, n_a long, block string")
    assert aligned(spark, frame) == sorted(brute_alignment(ODD), key=str)
    assert aligned(spark, frame.limit(0)) == []


def test_fragments_compose_in_any_order():
    sides = alignment.Sides(*(public_tokenizers.path(n) for n in ALIGNED_FILES))
    a, b = sides.encode("unbelievably antidisestablishmentarian words 日本語, again. " * 6)
    span = alignment.Span(a, np.cumsum(sides.length_a[a]), b, np.cumsum(sides.length_b[b]))
    parts = [alignment.fragment(sides, span.between(k * 5, (k + 1) * 5)) for k in range(len(span.a_end) * 3)]

    def fold(x, left):
        while len(x) > 1:
            n = 2 if left else len(x) - 2
            x = [alignment.compose(sides, x[0], x[1]), *x[2:]] if left else [*x[:n], alignment.compose(sides, x[-2], x[-1])]
        whole = alignment._whole(x[0], sides)
        return whole.groups, b"".join(whole.said), sorted(np.concatenate(whole.links).tolist())

    once = alignment.Fragment(prefix=alignment.NOTHING)
    once.close(sides, span)
    assert fold(parts, True) == fold(parts, False) == (once.groups, b"".join(once.said), sorted(np.concatenate(once.links).tolist()))


# --- sharding -----------------------------------------------------------------------------------------


def check_shards(rows, texts):
    """The law, gapless slots, sizes; returns the number of shards of each text."""
    counts, slots, where = Counter(), defaultdict(list), defaultdict(set)
    for r in rows:
        counts[r.shard] += 1
        slots[r.shard].append(r.slot)
        where[r.text_crc32, r.size].add(r.shard)
        assert r.law == "rows" and r.grown_shard is None and 0 <= r.shard < 8
    assert max(counts.values()) - min(counts[s] for s in range(8)) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    want = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in texts)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in rows) == want
    return {k: len(v) for k, v in where.items()}


def test_sharding_of_documents(spark):
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    where = check_shards(LLM_QUERIES["op13_sharding"](spark, SF).collect(), texts)
    assert set(where.values()) == {1}


@pytest.mark.parametrize("kind", ["hot", "pairs", "odd", "empty"])
def test_sharding_of_groups(spark, kind):
    texts = {
        "hot": [(i, "hot" if i % 3 == 0 else f"pair {i // 6}" if i % 3 == 1 else f"own {i}") for i in range(900)],
        "pairs": [(i, f"text {i // 2}") for i in range(400)],
        "odd": [(None, None), (None, ""), (1, None), (1, "x"), (1, "x"), (2, "y" * 10000), (3, "ä")],
        "empty": [],
    }[kind]
    frame = spark.createDataFrame([(i, t, i, "z") for i, t in texts], "doc_id long, text string, shard long, hub string")
    rows = sharding.shard(frame).collect()
    if not texts:
        assert rows == []
        return
    where = check_shards(rows, texts)
    if kind == "hot":
        hot = where.pop((zlib.crc32(b"hot"), 4))
        assert 3 <= hot <= 6 and sum(n > 1 for n in where.values()) <= 3
    if kind == "pairs":
        assert sum(n > 1 for n in where.values()) <= 0.2 * len(where)


def test_moves_keep_to_their_quotas():
    quota = sharding._quotas({(0, 1): 5, (1, 0): 3, (2, 1): 4}, [0, 3, 0])
    assert quota == [0, 5, 0, 3, 0, 0, 0, 1, 0]
