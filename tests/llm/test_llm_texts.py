"""Text operators against brute force, the tokenizer libraries and exact round trips."""

import hashlib
import random
import re
import tracemalloc
import unicodedata
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_fixtures import SCHEMA, awkward, empty, rows

from shelfwise.llm import _common, chat, graph, licenses, minhash, pieces, quality, token_counts
from shelfwise.llm.queries import vocabulary


# ---------------------------------------------------------------- near duplicates

def _set(text, k):
    w = (text or "").encode().lower().split()
    return {tuple(w)} if 0 < len(w) < k else {tuple(w[i:i + k]) for i in range(len(w) - k + 1)}


def _components(ids, linked):
    up = {i: i for i in ids}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i
    for a, b in linked:
        ra, rb = root(a), root(b)
        up[max(ra, rb)] = min(ra, rb)
    return {i: root(i) for i in ids}


def _family(rng, n, length, edits):
    base = [f"w{rng.randint(0, 5000)}" for _ in range(length)]
    out = []
    for _ in range(n):
        t = list(base)
        for _ in range(rng.randint(0, edits)):
            t[rng.randrange(len(t))] = f"v{rng.randint(0, 10**6)}"
        out.append(" ".join(t))
    return out


@pytest.mark.parametrize("k,block,nearest", [(2, 2000, 4), (5, 2000, 4), (2, 6, 1)])
def test_near_duplicates_are_exact(spark, monkeypatch, k, block, nearest):
    monkeypatch.setattr(minhash, "KEY_BLOCK", block)
    monkeypatch.setattr(minhash, "NEAREST", nearest)
    rng = random.Random(5)
    texts = [None, "", "  ", "One", "one", "one two", "ONE  two", "two one"]
    for n, length, edits in ((40, 60, 8), (25, 30, 3), (10, 200, 20), (6, 6, 1)):
        texts += _family(rng, n, length, edits)
    rng.shuffle(texts)
    docs = spark.createDataFrame(rows(texts), SCHEMA)
    sets = {i: _set(t, k) for i, t in enumerate(texts)}
    linked = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b]
              and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    want = _components(sets, linked)
    got = minhash.near_duplicates(docs, words=k, similarity=(80, 100)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got} == {
        i: (len(s), want[i], want[i] == i) for i, s in sets.items()}
    left = minhash.drop_near_duplicates(docs, words=k, similarity=(80, 100))
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.collect()) == sorted(i for i in sets if want[i] == i)


def test_near_duplicates_take_awkward_rows(spark):
    docs = awkward(spark)
    got = minhash.near_duplicates(docs, words=2).collect()
    assert len(got) == docs.count()
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert r.component_id <= r.doc_id and r.kept == (r.component_id == r.doc_id)
    left = [r.doc_id for r in minhash.drop_near_duplicates(docs, words=2).collect()]
    assert len([d for d in left if d is not None]) == len({d for d in left if d is not None})
    assert minhash.near_duplicates(empty(spark)).count() == 0
    assert minhash.drop_near_duplicates(empty(spark)).count() == 0


@pytest.mark.parametrize("nearest", [4, 1])
def test_near_duplicates_link_sets_whose_signatures_are_far_apart(spark, monkeypatch, nearest):
    monkeypatch.setattr(minhash, "NEAREST", nearest)
    # Similarity exactly 8/10 at signature distance 21; the only link between (0, 1) and (2, 3).
    x, y = (" ".join(f"w{1131190 + j}" for j in range(lo, lo + 9)) for lo in (0, 1))
    texts = [x, x + " left", y, y + " right"]
    sig = minhash.signatures(*minhash.shingle_sets(pa.array(texts), 1))
    assert (sig[0] != sig[2]).sum() == 21 and (minhash.chunk_keys(sig[:1]) == minhash.chunk_keys(sig[2:3])).any()
    got = minhash.near_duplicates(spark.createDataFrame(rows(texts), SCHEMA), words=1).collect()
    assert [r.component_id for r in sorted(got, key=lambda r: r.doc_id)] == [0, 0, 0, 0]


def test_near_duplicates_decide_rows_that_share_an_id_by_their_own_text(spark):
    a, b, c, d = (" ".join(f"{x}{j}" for j in range(20)) for x in "abcd")
    texts = [(1, a), (5, a + " more"), (5, b), (5, None), (7, c), (7, d), (7, d.upper()), (7, d), (9, c + " more"), (3, d + " more"),
             (8, b + " x"), (8, b + " y")]
    docs = spark.createDataFrame([(i,) + r[1:] for (i, _), r in zip(texts, rows([t for _, t in texts]))], SCHEMA)
    left = [(r.doc_id, r.text) for r in minhash.drop_near_duplicates(docs, words=2).collect()]
    assert sorted(left, key=str) == sorted([(1, a), (5, b), (5, None), (7, c), (3, d + " more")], key=str)


def test_components_of_a_long_path_and_a_star(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(200, 260)] + [(5, 5), (None, 3), (9, 8), (8, 9)]
    got = {r.node: r.component for r in graph.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 100 for i in range(101, 161)} | {i: 7 for i in range(200, 260)} | {9: 8}


# ---------------------------------------------------------------- tokens

HARD = ["", " ", "it's John'S o'clock ''s 'sss 'restaurant I'll we've don't 'd '' 'l 'll", "ΑΣ ΣΑΣ Σ", "İstanbul ǅ",
        "<|endoftext|>a<|startoftext|> <|END|>", "１２３ ½ ² 12345", "a b c​d\x1cx\x85y", "漢字かな 한국어 العربية हिन्दी",
        "👍🏽👨‍👩‍👧 !!! ?!?", "a" * 3000, "\x00\x01", "é" * 700 + "ab" * 500, "ﬁ ß ẞ", "\n\n a \t b\r\n", " " * 50 + "x", "<s></s><unk>"]


def _random_texts(seed, n):
    rng = random.Random(seed)
    alpha = "aebcst'’ \n.,!-é1Σßñ漢<|>\r"
    return ["".join(rng.choice(alpha) for _ in range(rng.randint(0, 60))) for _ in range(n)]


def test_token_counts_equal_the_library():
    tokenizers = pytest.importorskip("tokenizers")
    path = vocabulary("word_bpe_49k.json")
    lib, own = tokenizers.Tokenizer.from_file(path), token_counts.WordTokenizer(path)
    texts = HARD + _random_texts(1, 3000)
    want = [len(e.ids) for e in lib.encode_batch(texts, add_special_tokens=False)]
    assert token_counts.count_texts(own, texts).tolist() == want


def test_every_prefix_has_its_exact_count():
    tokenizers = pytest.importorskip("tokenizers")
    path = vocabulary("word_bpe_49k.json")
    lib, own = tokenizers.Tokenizer.from_file(path), token_counts.WordTokenizer(path)
    word = "internationalisationally"
    counts = own.prefixes(word.encode(), np.array([0]), np.array([len(word)]), every=True)[1]
    assert counts.tolist() == [len(lib.encode(word[:i + 1], add_special_tokens=False).ids) for i in range(len(word))]
    text = "We've seen 12 unbelievably long-winded réponses, haven't we? " * 3
    for budget in (0, 1, 2, 7, 19, 500):
        cut = own.cut(text, budget)
        normal = text.lower()
        assert normal.startswith(cut) and len(lib.encode(cut, add_special_tokens=False).ids) <= budget
        if len(cut) < len(normal):
            longer = max(i for i in range(len(normal) + 1) if len(lib.encode(normal[:i], add_special_tokens=False).ids) <= budget)
            assert len(normal[:longer].rstrip()) == len(cut.rstrip())


def test_cut_takes_special_strings_and_prefixes_of_contractions():
    tokenizers = pytest.importorskip("tokenizers")
    path = vocabulary("word_bpe_49k.json")
    lib, own = tokenizers.Tokenizer.from_file(path), token_counts.WordTokenizer(path)
    for text in ("One unbelievably<|endoftext|>we'll réponses<|startoftext|><|endoftext|> you've", "<|endoftext|>", "x 'll"):
        normal = "".join(p if p in own.special else p.lower() for p in re.split(r"(<\|[a-z]+\|>)", text))
        size = [len(lib.encode(normal[:i], add_special_tokens=False).ids) for i in range(len(normal) + 1)]
        assert own.prefix_table(text)[3][-1] == token_counts.count_texts(own, [text])[0] == size[-1]
        for budget in range(size[-1] + 2):
            longest = max(i for i in range(len(normal) + 1) if size[i] <= budget)
            assert own.cut(text, budget).rstrip() == normal[:longest].rstrip(), (text, budget)


def test_cut_to_budget_of_a_table_with_special_strings(spark):
    path = vocabulary("word_bpe_49k.json")
    docs = spark.createDataFrame(rows(["one two<|endoftext|>three four", None]), SCHEMA)
    got = {r.doc_id: r.text for r in token_counts.cut_to_budget(docs, path, 3).collect()}
    assert got[0].rstrip() == "one two<|endoftext|>" and got[1] is None


def test_token_counts_of_a_table(spark):
    tokenizers = pytest.importorskip("tokenizers")
    path = vocabulary("word_bpe_49k.json")
    lib = tokenizers.Tokenizer.from_file(path)
    docs = awkward(spark)
    got = token_counts.count(docs, path, limit=100).collect()
    want = sorted((r.doc_id is None, r.doc_id, len((r.text or "").encode()), len(lib.encode(r.text or "", add_special_tokens=False).ids))
                  for r in docs.collect())
    assert sorted((r.doc_id is None, r.doc_id, r.n_bytes, r.n_tokens) for r in got) == want
    assert all(r.over_limit == (r.n_tokens > 100) for r in got)
    assert token_counts.count(empty(spark), path).count() == 0
    assert token_counts.cut_to_budget(docs, path, 5).count() == len(got)


def test_pieces_equal_the_library():
    sentencepiece = pytest.importorskip("sentencepiece")
    path = vocabulary("piece_bpe_32k.model")
    lib, own = sentencepiece.SentencePieceProcessor(model_file=path), pieces.PieceTokenizer(path)
    texts = HARD + _random_texts(2, 3000) + ["a▁b", "▁", "▁▁ x"]
    lists, n, same = pieces.encode_column(own, pa.array(texts))
    want = lib.encode(texts)
    assert lists.to_pylist() == want and n.tolist() == [len(w) for w in want]
    assert same.tolist() == ["▁" not in t for t in texts]


def test_pieces_round_trip_as_tables(spark):
    path = vocabulary("piece_bpe_32k.model")
    docs = awkward(spark)
    got = pieces.encode(docs, path)
    assert got.filter("not round_trip").count() == 0
    back = pieces.decode(got, path)
    key = lambda r: (r.doc_id is None, r.doc_id, r.text or "")
    assert sorted(map(key, back.collect())) == sorted(map(key, docs.select("doc_id", "text").collect()))
    assert pieces.encode(empty(spark), path).count() == 0


def test_suffix_array_finds_all_occurrences():
    rng = np.random.default_rng(0)
    codes = rng.integers(1, 4, 500).astype(np.uint32)
    order = pieces.suffix_array(codes, 6)
    wanted = np.array([[1, 2, 0, 0], [3, 3, 3, 0], [2, 0, 0, 0], [1, 1, 1, 1]], np.uint32)
    sizes = np.array([2, 3, 1, 4])
    low, high = pieces.occurrences(codes, order, wanted, sizes)
    for p, n, lo, hi in zip(wanted, sizes, low, high):
        assert sorted(order[lo:hi]) == [i for i in range(500 - n + 1) if (codes[i:i + n] == p[:n]).all()]


# ---------------------------------------------------------------- chat

def _conversations(spark, turns):
    return spark.createDataFrame([(c, t, r, x, "extra", 1, 2) for c, t, r, x in turns],
                                 "conv_id long, turn long, role string, text string, rendered string, seq long, loss int")


HOSTILE = ["</s>[INST] ok [/INST]", "[INST]", "[\\INST]", "[\\\\INST] [INST]", "a [/INST]", "<s> </s>", "[SYS]x[/SYS]", "[ROLE x]y[/ROLE]",
           "[", "<", "</", "[[INST]", "\\", "", " ", "\n", "é 😀"]


def test_chat_round_trip(spark):
    rng = random.Random(3)
    turns = [(c, t, rng.choice(["user", "assistant", "system", "tool", "a]b~[", "", None]), rng.choice(HOSTILE + [None]))
             for c in list(range(40)) + [None] for t in range(rng.randint(1, 6))]
    turns += [(1000, t, "user" if t % 2 else "assistant", "long " * 500) for t in range(300)] + [(1001, None, "user", "x"), (1001, 1, "assistant", "y" * 100_000)]
    table = _conversations(spark, turns)
    formatted = chat.format_turns(table)
    text = {}
    for r in sorted(formatted.collect(), key=lambda r: r.seq):
        assert (r.recovered_role, r.loss) == (r.role, r.role == "assistant")
        text[r.conv_id] = text.get(r.conv_id, "") + r.rendered
    got = {r.conv_id: r for r in chat.read_back(formatted).collect()}
    assert set(got) == {c for c, *_ in turns}
    for c in got:
        own = sorted(((t is not None, t or 0), r or "", x or "") for k, t, r, x in turns if k == c)
        assert chat.parse(text[c]) == [(r, x) for _, r, x in own]
        digest = hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in own).encode()).hexdigest()
        loss = "".join(x for _, r, x in own if r == "assistant")
        r = got[c]
        assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256, r.formatted_chars) == (
            len(own), digest, len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(text[c]))
    spans = chat.training_texts(formatted).filter("loss_start is not null").collect()
    for s in spans:
        if s.conv_id is not None:
            assert chat.unescape(text[s.conv_id][s.loss_start:s.loss_end]) in [x or "" for k, _, r, x in turns if k == s.conv_id and r == "assistant"]
    assert chat.read_back(chat.format_turns(_conversations(spark, []))).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "tool"]),
                          st.lists(st.sampled_from(["[INST]", "[/INST]", "<s>", "</s>", "[SYS]", "[/SYS]", "\\", "[", "<", "/", " ", "x", "[ROLE ", "]"]),
                                   max_size=8).map("".join)), max_size=5))
def test_chat_grammar_recovers_any_turns(turns):
    rendered = "".join(chat.render_checked(r, t)[0] for r, t in turns)
    assert chat.parse(rendered) == turns


def test_texts_without_conflicts_stay_as_they_are():
    assert chat.render_checked("user", "a [x] <b> \\ c")[0] == "[INST] a [x] <b> \\ c [/INST]"


# ---------------------------------------------------------------- licenses

def _license_rows(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").encode().lower().decode())
    places, labels = [], set()
    for phrase, label in licenses.BASE.items():
        p = phrase.split()
        found = [i for i in range(len(words)) if words[i:i + len(p)] == p]
        places += found
        labels |= {label} if found else set()
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def test_license_base_phrases(spark):
    docs = awkward(spark).union(spark.createDataFrame(rows([
        "CC BY CC-BY cc  by!", "General Public\nLicense; GENERAL PUBLIC LICENSE", "all rights. reserved all rights", "ccby cc éby",
        "All RIGHTS reserved " * 2000]), SCHEMA))
    got = licenses.scan(docs).collect()
    key = lambda r: tuple((v is None, v) for v in r)
    want = sorted(((r.doc_id,) + _license_rows(r.text) for r in docs.collect()), key=key)
    assert sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got), key=key) == want
    assert licenses.scan(empty(spark)).count() == 0


@pytest.mark.parametrize("text,label", [
    ("Licensed under the Apache License, Version 2.0.", "apache-2.0"),
    ("Released under the MIT License.", "mit"),
    ("x is licensed under CC BY-NC 4.0.", "cc-by,cc-by-nc-4.0"),
    ("licensed under a Creative Commons CC BY 4.0", "cc-by,cc-by-4.0"),
    ("Copyright (c) 2020 Some Body Inc. All rights reserved.", "copyright-notice,reserved"),
    ("Copyright all rights reserved", "reserved"),
    ("This work is licensed under the terms of the GNU General Public License as published by the FSF, either version 3", "gpl,gpl-3.0"),
    ("licensed under the apache license version 3.0", ""),
])
def test_license_templates(text, label):
    found = licenses.Scanner(licenses.BASE, licenses.TEMPLATES).rows(pa.array([text, None]))
    assert found["labels"][0] == label and found["labels"][1] == ""
    assert found["score"][0] == (1.0 if any(x not in licenses.BASE.values() for x in label.split(",") if x) else 0.5 if label else 0.0)


def test_template_markup():
    vocabulary_ = {w: i for i, w in enumerate("a b c d".split())}
    a = licenses.Automaton("x", "a [[b]] {{1-2}} d", vocabulary_)
    for words, want in (("a c d", True), ("a b c d", True), ("a b d", True), ("a d", False), ("a c c d", True), ("a b c c d", True),
                        ("a b c c c d", False), ("a c", False)):
        assert a.found_in(np.array([vocabulary_[w] for w in words.split()])) == want, words


# ---------------------------------------------------------------- quality

def _labelled(n=1500, seed=2):
    rng = random.Random(seed)
    texts, good = [], []
    for i in range(n):
        w = ["".join(rng.choice("aeioustrn") for _ in range(rng.randint(2, 9))) for _ in range(rng.randint(5, 80))]
        bad = i % 4 == 0
        kind = i // 4 % 3
        if bad:
            w = [x.upper() + "!!" for x in w] if kind == 0 else [x + "$$$" for x in w] if kind == 1 else [x for x in w for _ in range(6)]
        texts.append(" ".join(w))
        good.append(int(not bad))
    return texts, good


def test_quality_ranks_held_out_documents(spark):
    texts, good = _labelled()
    docs = spark.createDataFrame(rows(texts + [None, "", "y" * 100_000]), SCHEMA)
    labels = spark.createDataFrame([(i, q, 0, 9.0) for i, q in enumerate(good)] + [(3, None, 0, 1.0), (99999, 1, 0, 1.0)],
                                   "doc_id long, quality int, toxic int, score double")
    got = {r.doc_id: r for r in quality.classify(docs, labels).collect()}
    assert len(got) == len(texts) + 3
    for i, r in got.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    held = [i for i in range(len(texts)) if got[i].held_out]
    assert sum(got[i].predicted == good[i] for i in held) >= 0.97 * len(held)
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, r in got.items() if r.score >= 0.3}


def test_quality_learns_nothing_from_the_held_out_fold(spark):
    texts, good = _labelled(400)
    docs = spark.createDataFrame(rows(texts), SCHEMA)
    flipped = [(i, 1 - q if zlib.crc32(str(i).encode()) % 5 == 0 else q) for i, q in enumerate(good)]
    a, b = (quality.classify(docs, spark.createDataFrame(x, "doc_id long, quality int")) for x in (list(enumerate(good)), flipped))
    assert {r.doc_id: r.score for r in a.collect()} == {r.doc_id: r.score for r in b.collect()}


def test_quality_takes_awkward_rows(spark):
    docs = awkward(spark)
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(30)], "doc_id long, quality int, toxic int")
    assert quality.classify(docs, labels).count() == docs.count()
    none = quality.classify(docs, labels.limit(0)).collect()
    assert {r.score for r in none} == {0.5}
    assert quality.classify(empty(spark), labels).count() == 0


def test_statistics_agree_with_plain_counting():
    text = "Ab AB ab ab!! É1 | x\nab ab\nab ab\n"
    s = dict(zip(quality.STATISTICS, quality.statistics(pa.array([text, ""]))[0]))
    raw = text.encode()
    assert s["log_bytes"] == pytest.approx(np.log1p(len(raw)))
    assert s["upper"] == pytest.approx(sum(unicodedata.category(c) == "Lu" for c in text) / len(raw))
    assert s["digit"] == pytest.approx(1 / len(raw)) and s["pipe"] == pytest.approx(1 / len(raw))
    words = text.split()
    assert s["words_distinct"] == pytest.approx(len(set(words)) / len(words))
    assert s["lines_repeated"] == pytest.approx(1 / 3)


def test_isotonic_is_the_monotone_fit():
    y = quality.isotonic(np.array([1.0, 0.0, 2.0, 1.5, 3.0]), np.array([1.0, 1, 1, 3, 1]))
    assert y.tolist() == [0.5, 0.5, 1.625, 1.625, 3.0]


def test_quality_scores_equal_a_plain_fit(spark):
    """Moments, features, normal equations, isotonic levels and knots in plain numpy over the same rows."""
    rng = random.Random(1)  # of no two pools that are equal but for their last bit, which keep a knot each
    good, bad = ["the", "river", "was", "calm.", "People", "walked", "home,"], ["BUY", "now!!!", "$$$", "x", "http://a", "1234"]
    n = 300
    y = [rng.random() < 0.5 for _ in range(n)]
    texts = [" ".join(rng.choice(good if (rng.random() < 0.6) == k else bad) for _ in range(rng.randint(3, 30))) for k in y]
    y = [k != (rng.random() < 0.2) for k in y]  # labels with noise: several isotonic levels
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(k)) for i, k in enumerate(y)], "doc_id long, quality int")
    got = {r.doc_id: r for r in quality.classify(docs, labels, waves=48).collect()}
    x = quality.statistics(pa.array(texts))
    target = np.array(y, float)
    train = np.array([zlib.crc32(str(i).encode()) % 5 != 0 for i in range(n)])
    scale = x.std(0)
    z = np.clip((x - x.mean(0)) / np.where(scale > 1e-9, scale, 1.0), -8, 8)
    seeded = np.random.Generator(np.random.PCG64(11))
    frequencies, phases = seeded.normal(0.0, 0.1, (x.shape[1], 48)), seeded.uniform(0.0, 2 * np.pi, 48)
    features = np.hstack([np.cos(z @ frequencies + phases) * np.sqrt(2 / 48), np.ones((n, 1))])
    a = features[train]
    raw = features @ np.linalg.solve(a.T @ a + 1e-6 * len(a) * np.eye(49), a.T @ target[train])
    cell = np.floor((np.clip(raw, -1, 2) + 1) / 3 * (quality.GRID - 1)).astype(int)
    cells = sorted(set(cell[train]))
    members = [train & (cell == c) for c in cells]
    size = np.array([m.sum() for m in members], float)
    mean_y = np.array([target[m].mean() for m in members])
    mean_raw = np.array([np.clip(raw[m], -1, 2).mean() for m in members])
    # Least squares under order by its min-max formula.
    k = len(cells)
    level = np.array([max(min(np.average(mean_y[i:j + 1], weights=size[i:j + 1]) for j in range(b, k)) for i in range(b + 1)) for b in range(k)])
    groups = np.split(np.arange(k), np.flatnonzero(np.diff(level) > 1e-12) + 1)
    knots = [np.average(mean_raw[g], weights=size[g]) for g in groups]
    want = np.clip(np.interp(raw, knots, [level[g[0]] for g in groups]), 0, 1)
    assert len(groups) > 3
    for i in range(n):
        assert got[i].held_out == (not train[i]) and abs(got[i].score - want[i]) < 1e-6
        assert got[i].predicted == int(got[i].score >= 0.3)


def test_hashing_steps_hold_little_memory():
    """The near-duplicate and quality tasks of the pipeline: arrays of a few steps of 512 KB, whatever the batch's size."""
    rng = random.Random(3)
    texts = [" ".join(rng.choice("abcdefgh") * rng.randint(1, 9) for _ in range(3000)) for _ in range(300)]
    n = len(texts)
    batch = pa.RecordBatch.from_pydict({"doc_id": np.arange(n), "text_hash": np.arange(n), "text": texts})
    assert sum(map(len, texts)) > 5_000_000
    _common._powers[:] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]
    tracemalloc.start()
    try:
        parts = [p.select(["doc_id", "n_shingles", "set_a"]) for p in minhash.signature_rows(iter([batch]), 5)]
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 50 << 20, peak
    assert sum(p.num_rows for p in parts) == n and len(parts) > 8
    hashes, bounds = minhash.shingle_sets(batch.column("text"), 5)
    assert [x for p in parts for x in p.column("n_shingles").to_pylist()] == np.diff(bounds).tolist()
    assert [x for p in parts for x in p.column("set_a").to_pylist()] == minhash._set_key(hashes, bounds)[0].tolist()
