"""Packing, chat, language ID, WARC, piecewise hashing, mixing and perplexity."""

import base64
import hashlib
import io
import math
import zipfile
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from virotide.llm import chat, ctph, langid, mixing, packing, perplexity, warc
from virotide.llm.queries import LLM_ORACLES, LLM_QUERIES, tokenizer_path

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs_of(spark, texts, extra=(), lang="en", source="s"):
    out = spark.createDataFrame([(i, t, lang, source, None) for i, t in texts], DOCS)
    for name in extra:
        out = out.selectExpr("*", f"doc_id AS `{name}`")
    return out


def rows_of(spark, name):
    return spark.read.parquet(f"{SF}/{name}.parquet").collect()


# --- packing ------------------------------------------------------------------------------------------


def check_places(pieces, capacity):
    by = defaultdict(list)
    for p in pieces:
        by[p.sequence_id].append((p.offset, p.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def test_packing_of_documents(spark):
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(tokenizer_path())
    out = LLM_QUERIES["op3_packing"](spark, SF).collect()
    want = {}
    for r in rows_of(spark, "documents"):
        ids = [*model.encode(r.text or "", add_special_tokens=False).ids, 0]
        for n, start in enumerate(range(0, len(ids), 2048)):
            part = ids[start : start + 2048]
            want[r.doc_id, n] = (start, len(part), zlib.crc32(np.array(part, dtype="<u4").tobytes()))
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in out} == want
    made = check_places(out, 2048)
    assert made <= math.ceil(sum(r.length for r in out) / 2048) + 2


def test_word_tables_give_the_tokenizers_ids():
    from tokenizers import Tokenizer

    model, own = Tokenizer.from_file(tokenizer_path()), packing.WordTokens(tokenizer_path())
    texts = ["", " ", "It's <|endoftext|> ok l'été—,x «a».b", "'tis don't ÀB́c ΑΣ, ΣΑΣ", "x\u000by\u001cz q", "a'b,c ſ İx <|ENDOFTEXT|>b", "3.14 a3b --- ''' 's'S", "ßÿÀÖ÷× ÞØ é,"]
    for text in texts * 2:
        assert list(own.ids(text)) == [*model.encode(text, add_special_tokens=False).ids, 0], text


def test_word_tables_are_bounded(monkeypatch):
    monkeypatch.setattr(packing, "TABLE_ENTRIES", 3)
    own, free = packing.WordTokens(tokenizer_path()), packing.WordTokens(tokenizer_path())
    text = "one two, three four five. six one two seven"
    assert list(own.ids(text)) == list(free.ids(text))
    assert len(own.words) <= 3 and len(own.stems) <= 3


def test_packing_cases(spark):
    frame = docs_of(spark, [(1, None), (1, None), (2, ""), (None, "word " * 50)], ["offset", "piece", "sequence_id"])
    out = packing.pack(packing.tokenize(frame, tokenizer_path(), capacity=16), capacity=16).collect()
    assert Counter((r.doc_id, r.length) for r in out) == Counter({(1, 1): 2, (2, 1): 1, (None, 16): 3, (None, 3): 1})
    assert all(len(r.ids) == 4 * r.length for r in out)
    check_places(out, 16)
    assert packing.pack(packing.tokenize(docs_of(spark, []), tokenizer_path())).count() == 0


def test_open_bins_close_the_fullest():
    bins = packing.OpenBins(10, 2)
    assert [bins.place(n) for n in (6, 7, 3, 8)] == [(0, 0), (1, 0), (1, 7), (2, 0)]
    assert bins.place(9) == (3, 0)  # bin 2 (2 free) closes, not bin 0 (4 free)
    assert bins.place(4) == (0, 6)
    assert bins.place(1) == (3, 9)


# --- chat ---------------------------------------------------------------------------------------------


def test_chat_of_conversations(spark):
    want = defaultdict(list)
    for r in sorted(rows_of(spark, "conversations"), key=lambda r: (r.conv_id, r.turn)):
        want[r.conv_id].append((r.role, r.text or ""))
    said = "\\### Assistant: </turn> ok"
    want[-7] = [("user", said), ("assistant", said)]
    got = {r.conv_id: tuple(r)[1:] for r in LLM_QUERIES["op4_chat"](spark, SF).collect()}
    assert got.keys() == want.keys()
    for conv, turns in want.items():
        masked = "".join(t for role, t in turns if role == "assistant")
        sha = [hashlib.sha256(x.encode()).hexdigest() for x in ("".join(f"{a}\n{b}\n" for a, b in turns), masked)]
        assert got[conv][:4] == (len(turns), sha[0], len(masked), sha[1])


@pytest.mark.parametrize("text", ["", "\\", "<turn>", "</turn>\n<turn>user\n", "a\\</turn>\\\\", "\\n", "<turn", "x\n</turn>"])
def test_chat_round_trip(text):
    turns = [("user", text), ("assistant", text), ("odd\nrole</turn>\\n", text)]
    formatted, spans = chat.render(turns)
    assert chat.read_back(formatted) == turns
    assert [chat.unescape(formatted[a:b]) for a, b in spans] == [text]


def test_reply_trees(spark):
    rows = [
        (1, 1, None, "user", "q", 0.0), (1, 2, 1, "assistant", "a", 1.0), (1, 3, 1, "assistant", "b", 4.0), (1, 4, 3, "user", "c", 0.0),
        (1, 5, 3, "user", "d", 0.0), (1, 6, 2, "user", "e", 0.5), (2, 1, 99, "user", None, None), (None, 1, None, None, "t", 1.0),
        (1, 6, 2, "user", "e", 0.5), (3, 1, 2, "user", "x", 1.0), (3, 2, 1, "user", "y", 1.0),
    ]
    frame = spark.createDataFrame(rows, "tree_id long, msg_id long, parent_id long, role string, text string, score double").selectExpr("*", "msg_id AS rank", "1 AS tree", "2 AS up")
    every = defaultdict(list)
    for r in chat.paths(frame, None).collect():
        every[r.tree_id, r.leaf_id].append((r.depth, r.text))
    assert {k: [t for _, t in sorted(v)] for k, v in every.items()} == {
        (1, 4): ["q", "b", "c"], (1, 5): ["q", "b", "d"], (1, 6): ["q", "a", "e"], (2, 1): [""], (None, 1): ["t"],
    }
    best = {(r.tree_id, r.leaf_id, r.rank) for r in chat.conversations(frame, 2).collect()}
    assert best == {(1, 4, 1), (1, 5, 2), (2, 1, 1), (None, 1, 1)}
    assert chat.conversations(frame.limit(0)).count() == 0


def test_long_chain(spark):
    rows = [(1, t, "user" if t % 2 == 0 else "assistant", f"t{t}") for t in range(70)]
    out = chat.digests(chat.conversations(chat.chain(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")))).collect()
    assert [(r.conv_id, r.n_turns) for r in out] == [(1, 70)]


# --- language ID --------------------------------------------------------------------------------------


def test_language_accuracy_on_held_out(spark):
    lang = {r.doc_id: r.lang for r in rows_of(spark, "documents")}
    out = [r for r in LLM_QUERIES["op5_langid"](spark, SF).collect()]
    assert len(out) == len(lang)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in out)
    held = [r for r in out if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.97 * len(held)


def test_language_cases(spark):
    learned = langid.learn(spark.read.parquet(f"{SF}/documents.parquet"))
    frame = docs_of(spark, [(1, None), (2, "123 !?"), (3, ""), (4, "qzxj wvkq zzxq"), (None, "a")], ["score", "language", "lang_pred"])
    out = {r.doc_id: r["language"] for r in langid.predict(frame, learned).collect()}
    assert all(out[i].lang_pred == "und" and out[i].score == 0 for i in (1, 2, 3))
    assert out[4].lang_pred in learned.languages and out[4].score < 0.25
    assert langid.known_language(frame, learned).columns == frame.columns
    assert {r.doc_id for r in langid.known_language(frame, learned).collect()} <= {None}
    nothing = langid.learn(docs_of(spark, [(1, "some text")], lang=None))
    assert nothing.languages == [] and langid.predict(frame, nothing).count() == 5
    assert langid.learn(docs_of(spark, [])).languages == []


def test_filters_return_every_language_of_a_gram():
    grams = [langid.grams(f"word{chr(97 + k % 26)}{chr(97 + k // 26)} common", 4) for k in range(70)]
    table = np.zeros((1 << 14, 2), dtype=np.uint64)
    for k, own in enumerate(grams):
        for probe in range(3):
            table[langid.positions(own, probe, len(table)), k // 64] |= np.uint64(1 << (k % 64))
    filters = langid.LanguageFilters([f"l{k:02}" for k in range(70)], table, 4, 3)
    shared = filters.masks(langid.grams("common", 4))
    assert (shared[:, 0] == np.uint64(2**64 - 1)).all() and (shared[:, 1] == np.uint64(63)).all()


# --- WARC ---------------------------------------------------------------------------------------------


def test_warc_of_pages(spark):
    pages = rows_of(spark, "pages")
    groups = defaultdict(list)
    for p in pages:
        groups[(p.html or "").encode()].append(p.page_id)
    want = {}
    for data, ids in groups.items():
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        for i in ids:
            want[i] = (len(data), digest, "response" if i == max(ids) else "revisit", None if i == max(ids) else max(ids))
    assert {r.page_id: tuple(r)[1:] for r in LLM_QUERIES["op6_warc"](spark, SF).collect()} == want


def test_warc_cases(spark):
    rows = [(1, "http://a/ b\r\nX: y", "same"), (4, None, "same"), (4, None, "same"), (None, "u", "same"), (2, "u", None), (3, "u", ""), (5, "u", "\r\n\r\nWARC/1.1 é")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS refers_to", "2 AS payload", "'x' AS sha1")
    out = Counter((r.page_id, r.url, None if r.payload is None else bytes(r.payload).decode(), r.payload_bytes, r.record_type, r.refers_to) for r in warc.round_trip(frame).collect())
    assert out == Counter([
        (1, "http://a/%20b%0D%0AX:%20y", None, 4, "revisit", 4), (4, None, "same", 4, "response", None), (4, None, "same", 4, "response", None),
        (None, "u", None, 4, "revisit", 4), (2, "u", None, 0, "revisit", 3), (3, "u", "", 0, "response", None), (5, "u", "\r\n\r\nWARC/1.1 é", 15, "response", None),
    ])
    least = {r.page_id: r.record_type for r in warc.round_trip(frame.where("page_id in (1, 2, 3, 4)"), least_bytes=1).collect()}
    assert least == {1: "revisit", 2: "response", 3: "response", 4: "response"}
    assert warc.round_trip(frame.limit(0)).count() == 0


@pytest.mark.parametrize("wide", [False, True])
def test_zip_directories(monkeypatch, wide):
    if wide:  # ZIP64 forms everywhere
        monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 10)
        monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 1)
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for k in range(4):
            with z.open(f"archive/{k}", "w", force_zip64=True) as f:
                f.write(bytes([65 + k]) * (30 + k))
        z.comment = b"a comment"
    data = out.getvalue()
    assert (warc.END64 in data) == wide
    found = warc.members(lambda at, n: data[at : at + n], len(data))
    assert [(name, data[at : at + n]) for name, at, n in found] == [(f"archive/{k}", bytes([65 + k]) * (30 + k)) for k in range(4)]


def test_zip_refuses_compressed_members():
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("a", "b" * 100)
    with pytest.raises(ValueError, match="compressed"):
        warc.members(lambda at, n: out.getvalue()[at : at + n], len(out.getvalue()))


# --- piecewise hashing --------------------------------------------------------------------------------


def test_ctph_of_documents(spark):
    texts = {r.doc_id: r.text or "" for r in rows_of(spark, "documents")}
    order = sorted(texts, reverse=True)
    make = ctph.Fingerprinter()
    out = {r.doc_id: r for r in LLM_QUERIES["op7_ctph"](spark, SF).collect()}
    assert out.keys() == texts.keys()
    for i, following in zip(order, [*order[1:], order[0]], strict=True):
        text, third = texts[i], len(texts[i]) // 3
        changed = text[: len(text) - third] + texts[following][:third]
        prints = [make(t.encode()) for t in (text, changed, texts[following])]
        r = out[i]
        assert (r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint) == (len(text), hashlib.sha256(changed.encode()).hexdigest(), *prints[:2])
        assert r.near_edited == ctph.likeness(*prints[:2]) and r.near_next == ctph.likeness(prints[0], prints[2])
    long = [r for r in out.values() if r.n_chars > 300]
    assert sum(r.near_edited > r.near_next for r in long) > 0.95 * len(long)


def test_ctph_parts_and_slices(monkeypatch):
    data = bytes(np.random.default_rng(1).integers(97, 123, 5000, dtype=np.uint8))
    whole = ctph.Fingerprinter()(data)
    monkeypatch.setattr(ctph, "SLICE", 700)
    assert ctph.Fingerprinter()(data) == whole
    assert ctph.likeness(whole, ctph.Fingerprinter()(data[:2500] + b"!" + data[2500:])) > 0.9
    assert ctph.likeness(whole, ctph.Fingerprinter()(data[::-1])) < 0.3


def test_common_length():
    import random

    random.seed(2)
    for _ in range(50):
        a, b = ("".join(random.choices("abcd", k=random.randint(0, 20))) for _ in range(2))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        assert ctph.common_length(a, b) == table[-1][-1]


def test_ctph_cases(spark):
    frame = docs_of(spark, [(1, None), (2, ""), (None, "abcdef"), (3, "xyz" * 40), (3, "xyz" * 40)], ["part", "border", "fingerprint"])
    out = sorted(((r.doc_id, r.n_chars) for r in ctph.with_next(frame).collect()), key=str)
    assert out == [(1, 0), (2, 0), (3, 120), (3, 120), (None, 6)]
    one = ctph.with_next(docs_of(spark, [(7, "lonely text")])).collect()
    assert len(one) == 1 and one[0].near_next == 1.0
    assert ctph.with_next(docs_of(spark, [])).count() == 0
    assert ctph.likeness("3::", "3::") == 1.0 and ctph.likeness("3::", "3:abc:d") == 0.0


# --- mixing -------------------------------------------------------------------------------------------


def test_mixing_of_documents(spark):
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = db.execute(LLM_ORACLES["op8_mixing"])
    names = [d[0] for d in want.description]
    out = LLM_QUERIES["op8_mixing"](spark, SF)
    assert Counter(tuple(r) for r in out.select(*names).collect()) == Counter(want.fetchall())
    places = [r.place for r in out.collect()]
    assert places == sorted(places)


def test_mixing_reaches_its_targets(spark):
    rows = [(i, "x" * 10, "en", "a" if i % 4 else "b", None) for i in range(4000)]
    frame = spark.createDataFrame(rows, DOCS)
    count = Counter(r.source for r in mixing.replicate(frame, {"a": 0.25, "b": 0.75}, epochs=2.0).select("source").collect())
    assert abs(count["a"] - 2000) < 200 and abs(count["b"] - 6000) < 350
    heavy = mixing.replicate(frame.where("doc_id < 40"), {"b": 1.0}, epochs=30.0).collect()  # a mean above 8: several draws
    assert {r.source for r in heavy} == {"b"} and abs(len(heavy) - 1200) < 150


def test_mixing_cases(spark):
    rows = [(1, "abc", "en", None, None), (1, "abc", "en", None, None), (None, "abc", "en", "s", None), (2, None, "en", "empty", None)]
    frame = spark.createDataFrame(rows, DOCS).selectExpr("*", "7 AS copy", "8 AS draws", "'s' AS target", "9 AS size")
    out = mixing.replicate(frame, epochs=5.0)
    assert out.columns == [*[c for c in frame.columns if c != "copy"], "n_copies", "copy", "place"]
    got = out.collect()
    assert len([r for r in got if r.doc_id == 1]) % 2 == 0 and not [r for r in got if r.source == "empty"]
    assert mixing.replicate(frame.limit(0)).count() == 0
    assert mixing.replicate(frame, {}).count() == 0


# --- perplexity ---------------------------------------------------------------------------------------


def slow_model(texts):
    """Interpolated modified Kneser-Ney over character 5-grams of one language."""
    n = perplexity.ORDER
    counts = {n: Counter()}
    for t in texts:
        padded = "\x02" * (n - 1) + " ".join(t.lower().split())
        counts[n].update(padded[i : i + n] for i in range(len(padded) - n + 1))
    for k in range(n - 1, 0, -1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])
    cut, tails = {}, defaultdict(list)
    for k, level in counts.items():
        often = Counter(min(c, 5) for c in level.values())
        y = often[1] / (often[1] + 2 * often[2]) if often[1] + 2 * often[2] else None
        for j in (1, 2, 3):
            known = y is not None and often[j]
            cut[k, j] = min(max(j - (j + 1) * y * often[j + 1] / often[j] if known else 0.5 * j, 0.05), j - 0.05)
        for g, c in level.items():
            tails[g[:-1], k].append(c)

    def p(gram):
        out = perplexity.UNSEEN
        for k in range(1, n + 1):
            g = gram[n - k :]
            tail = tails.get((g[:-1], k))
            if tail:
                c = counts[k][g]
                share = (c - cut[k, min(c, 3)]) / sum(tail) if c else 0.0
                out = share + sum(cut[k, min(t, 3)] for t in tail) / sum(tail) * out
        return out

    def score(text):
        padded = "\x02" * (n - 1) + " ".join(text.lower().split())
        grams = [padded[i : i + n] for i in range(len(padded) - n + 1)]
        return -sum(math.log(p(g)) for g in grams) / len(grams) if grams else 0.0

    return score


def slow_base(text):
    words = [w for w in __import__("re").split("[ \t-\r]+", text) if w]
    windows = Counter(zip(words, words[1:], words[2:], strict=False))
    hit = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), sum(x in lines[:i] for i, x in enumerate(lines)), len(hit)


def test_perplexity_of_documents(spark):
    docs = rows_of(spark, "documents")
    by = defaultdict(list)
    for r in docs:
        by[r.lang].append(r.text or "")
    models = {lang: slow_model(texts) for lang, texts in by.items()}
    out = {r.doc_id: r for r in LLM_QUERIES["op10_perplexity"](spark, SF).collect()}
    assert out.keys() == {r.doc_id for r in docs}
    for r in docs:
        got, base = out[r.doc_id], slow_base(r.text or "")
        assert tuple(got[c] for c in perplexity.BASE) == base
        assert got.base_failed == (base[0] < 50 or 100 * base[4] > 50 * base[0])
        assert got.log_ppl == pytest.approx(models[r.lang](r.text or ""), rel=1e-4)
        assert got.kept == (not got.base_failed and got.low <= got.log_ppl <= got.high)
    passing = [r for r in out.values() if not r.base_failed]
    assert sum(r.kept for r in passing) > 0.9 * len(passing)


def test_perplexity_cases(spark, monkeypatch):
    texts = [(1, None), (2, ""), (None, "word " * 60), (3, "a\n a\na\n\n"), (3, "a\n a\na\n\n"), (4, " ".join(f"w{i}" for i in range(80)))]
    frame = docs_of(spark, texts, ["value", "key", "n", "gram"], lang=None)
    out = perplexity.judge(frame).collect()
    assert Counter(r.doc_id for r in out) == Counter([1, 2, None, 3, 3, 4])
    got = {r.doc_id: r for r in out}
    assert (got[3].n_words, got[3].n_dup_lines) == (3, 1) and got[None].base_failed and got[4].kept and not got[1].kept
    assert perplexity.judge(docs_of(spark, [])).count() == 0


def test_perplexity_slices(monkeypatch):
    text = "the quick brown fox jumps over the lazy dog " * 30
    whole = [p for _, parts in perplexity._slices([text]) for p in parts]
    monkeypatch.setattr(perplexity, "SLICE", 100)
    cut = [p for _, parts in perplexity._slices([text]) for p in parts]
    grams = lambda parts: Counter(tuple(p[i : i + 5]) for p in parts for i in range(len(p) - 4))
    assert len(cut) > 5 and grams(whole) == grams(cut)
