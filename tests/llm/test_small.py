"""The corpus operators against brute force on small tables."""

import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from ratelens.llm import langid, packing, queries, repair, sharding, winnowing

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang").collect()
    return {r["doc_id"]: (r["text"], r["lang"]) for r in rows}


@pytest.fixture(scope="module")
def odd(spark):
    """Null, empty, very long and repeated texts, a null id and columns with clashing names."""
    texts = [None, "", "a", "word " * 60_000, "same text here", "same text here", " \n ", "x" * 50_000, "çà İΣ ½ <|endoftext|>", None]
    rows = [(i if i != 9 else None, t, None, 1, 2, 3) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, shard int, slot int, rank int")


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


def encode_all(texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(queries.word_bpe())
    return [e.ids for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_token_files_hold_the_ids(spark, docs):
    got = {r["doc_id"]: r for r in queries.op3_repair_token_files(spark, SF).collect()}
    assert set(got) == set(docs)
    at = 0
    ordered = sorted(docs)
    for d, ids in zip(ordered, encode_all([docs[d][0] for d in ordered])):
        r, ids = got[d], [*ids, 1]
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (at, len(ids), crc(ids))
        at += len(ids)


def test_ids_are_the_library_s_with_added_tokens_in_the_text():
    from ratelens.llm.tokens import encoder

    texts = ["a <|endoftext|> b", "glued<|endoftext|>on", "<|ENDOFTEXT|> <|EndOfText|>", "<|startoftext|><|endoftext|>", "x<|startoftext|>.", "<|endoftext", "plain", None, ""]
    got = [ids.tolist() for ids in encoder(queries.word_bpe()).encode_all(texts * 2)]
    assert got == encode_all(texts) * 2 and 49407 in got[0] and 49407 not in got[2]


def test_ids_stay_the_same_when_the_table_of_words_is_full(docs, monkeypatch):
    from ratelens.llm import tokens

    monkeypatch.setattr(tokens, "MAX_CHUNKS", 300)
    monkeypatch.setattr(tokens, "GROUP_CHARS", 2000)
    texts = [t for t, *_ in docs.values()][:150] * 2
    codec = tokens.ChunkEncoder(queries.word_bpe())
    assert [ids.tolist() for ids in codec.encode_all(texts)] == encode_all(texts)
    assert codec.n < 3000


def test_new_words_go_to_the_tokenizer_once_and_in_small_pieces(docs, monkeypatch):
    from ratelens.llm import tokens

    monkeypatch.setattr(tokens, "ADD_CHUNKS", 40, raising=False)
    codec, sent = tokens.ChunkEncoder(queries.word_bpe()), []
    monkeypatch.setattr(codec, "_add", lambda chunks, add=codec._add: (sent.append(list(chunks)), add(chunks)))
    texts = ["", None, " \t\n ", " a  b\x0b", "a\x1cb c\u00a0d", "x" * 300, *[t for t, *_ in docs.values()][:60]]
    assert [ids.tolist() for ids in codec.encode_all(texts)] == encode_all(texts)
    words = [w for some in sent for w in some]
    assert max(map(len, sent)) <= 40 < len(words) == len(set(words))


def test_plain_words_go_straight_to_the_model(docs, monkeypatch):
    from ratelens.llm import tokens

    codec, whole = tokens.ChunkEncoder(queries.word_bpe()), []
    monkeypatch.setattr(codec, "_of_words", lambda words, encode=codec._of_words: (whole.extend(words), encode(words))[1])
    odd = ["e\u0301t\u00e9 \u00c9T\u00c9 \u00df \u1e9e \u00aa \u00b5 \u00ff\u0178 \u0130 \u00d7\u00f7", "o'neil's 's don't \u00e9's a1 x$$$ \u00c5\u00e5\u030a", "\u00de\u00fe\u00d0\u00f0", "z" * 300]
    texts = [*odd, *[t for t, *_ in docs.values()][:100], *odd]
    assert [ids.tolist() for ids in codec.encode_all(texts)] == encode_all(texts)
    assert "x$$$" in whole and not [w for w in whole if w.isascii() and w.isalpha()]


def test_other_work_drops_the_table_of_words():
    from ratelens.llm import chosen_path, langid, tokens

    for operator in (chosen_path, langid):
        assert tokens.encoder(queries.word_bpe()) is tokens.encoder(queries.word_bpe())
        operator.forget()
        assert not tokens._ENCODERS


def test_token_files_of_odd_rows(spark, odd, empty, tmp_path):
    repair.write_shards(odd, f"{tmp_path}/odd", queries.word_bpe())
    got = repair.read_documents(spark, f"{tmp_path}/odd").collect()
    assert Counter(r["doc_id"] for r in got) == Counter([*range(9), None])
    assert {r["start"] for r in got if r["doc_id"] is None} == {0}
    repair.write_shards(empty, f"{tmp_path}/none", queries.word_bpe())
    assert repair.read_documents(spark, f"{tmp_path}/none").collect() == []


def test_one_document_is_decoded_alone():
    rng = np.random.default_rng(1)
    texts = [rng.integers(0, 12, n).astype(np.uint32) for n in (1, 4000, 2, 3000)]
    row = repair._shard(0, 0, [1, 2, 3, 4], texts).to_pylist()[0]
    assert len(row["symbols"]) // 2 < 5000 and len(row["rules"])
    for k, t in enumerate(texts):
        assert repair.decode_document(row, k).tolist() == t.tolist()


def slow_expand(symbol, rules):
    if symbol < repair.BASE:
        return [symbol]
    left, right, length = rules[symbol - repair.BASE].tolist()
    out = slow_expand(left, rules) + slow_expand(right, rules)
    assert len(out) == length
    return out


@pytest.mark.parametrize("texts", [
    [[5] * 1000], [[5] * n for n in (1, 2, 3, 4, 7, 8)], [[1, 2, 3] * 400, [1, 2, 3] * 399 + [9]], [list(range(3000))] * 9, [[0, 0, 1, 1, 0, 0, 0, 1] * 50], [[7]],
    [[i % 3, 8, 8, 8, i % 5] for i in range(60)],
])
def test_rules_go_on_until_no_pair_repeats(texts):
    texts = [np.array(t, np.uint32) for t in texts]
    row = repair._shard(0, 0, list(range(len(texts))), texts).to_pylist()[0]
    rules, symbols = np.frombuffer(row["rules"], repair.RULE), np.frombuffer(row["symbols"], "<u2").tolist()
    assert [len(t) for t in texts] == row["doc_tokens"] and len(symbols) == sum(row["doc_symbols"])
    left, at = Counter(), 0
    for k, (t, n) in enumerate(zip(texts, row["doc_symbols"])):
        own, at = symbols[at : at + n], at + n
        assert sum((slow_expand(s, rules) for s in own), []) == t.tolist() == repair.decode_document(row, k).tolist()
        i = 0
        while i + 1 < n:  # occurrences that do not overlap
            left[own[i], own[i + 1]] += 1
            i += 2 if i + 2 < n and own[i] == own[i + 1] == own[i + 2] else 1
    assert max(left.values(), default=1) == 1


def test_rules_end_with_the_symbols_of_two_bytes():
    rng = np.random.default_rng(2)
    text = np.tile(rng.permutation(40_000), 2).astype(np.uint32)  # 39,999 pairs occur twice
    row = repair._shard(0, 0, [1], [text]).to_pylist()[0]
    assert len(row["rules"]) // repair.RULE.itemsize == repair.SYMBOLS - repair.BASE
    assert repair.decode_document(row, 0).tolist() == text.tolist()


def check_packing(rows, capacity):
    by_seq = defaultdict(list)
    for r in rows:
        by_seq[r["sequence_id"]].append((r["offset"], r["length"]))
    for items in by_seq.values():
        at = 0
        for offset, length in sorted(items):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by_seq)


def test_packing_keeps_every_token(spark, docs):
    rows = queries.op6_histogram_packing(spark, SF).collect()
    n = check_packing(rows, 2048)
    total = 0
    by_doc = defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
    for d, ids in zip(docs, encode_all([t for t, _ in docs.values()])):
        ids = [*ids, 0]
        total += len(ids)
        want = [(p, s, len(ids[s : s + 2048]), crc(ids[s : s + 2048])) for p, s in enumerate(range(0, len(ids), 2048))]
        assert sorted((r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in by_doc[d]) == want
    assert n <= -(-total // 2048) * 1.02 + 1


def test_best_fit_over_counts_equals_best_fit_over_pieces():
    rng = np.random.default_rng(5)
    for capacity in (10, 64, 100):
        lengths = rng.integers(1, capacity + 1, 500).tolist() + [1] * 7 + [capacity] * 9
        plan = packing.best_fit(dict(Counter(lengths)), capacity)
        rooms = []
        for length in sorted(lengths, reverse=True):
            fit = [r for r in rooms if r >= length]
            if fit:
                rooms.remove(min(fit))
            rooms.append((min(fit) if fit else capacity) - length)
        assert plan.sequences == len(rooms)
        seen = Counter()
        rows = []
        for length in lengths:
            s, o = plan.place(np.array([length]), np.array([seen[length]]))
            seen[length] += 1
            rows.append({"sequence_id": int(s[0]), "offset": int(o[0]), "length": length})
        assert check_packing(rows, capacity) == len(rooms)


def test_packing_of_odd_rows(spark, odd, empty):
    rows = packing.pack(odd, queries.word_bpe(), capacity=2048).collect()
    check_packing(rows, 2048)
    assert {r["doc_id"] for r in rows} == {*range(9), None}
    assert packing.pack(empty, queries.word_bpe()).collect() == []


def check_shards(rows, n):
    sizes = Counter(r["shard"] for r in rows)
    assert max(sizes.values()) - min(sizes.get(s, 0) for s in range(n)) <= 1
    for s in sizes:
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(sizes[s]))


def test_shards_have_exact_sizes(spark, docs):
    rows = queries.op7_matrix_shards(spark, SF).collect()
    check_shards(rows, 40)
    assert {r["doc_id"]: (r["size"], r["text_crc32"]) for r in rows} == {
        d: (len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for d, (t, _) in docs.items()}


def test_shards_of_odd_rows(spark, odd, empty):
    rows = sharding.uniform_shards(odd, ["doc_id", "text"], 3).collect()
    check_shards(rows, 3)
    assert len(rows) == 10 and all(r["rank"] == 3 for r in rows)
    assert sharding.uniform_shards(empty, ["doc_id"], 3).collect() == []


def test_documents_are_written_by_shard(spark, tmp_path):
    rows = [(i, f"t{i % 50}") for i in range(300)] + [(7, "same")] * 40 + [(None, None)] * 3
    df = spark.createDataFrame([(*r, 5, 6) for r in rows], "doc_id long, text string, slot int, c0 int")
    sharding.write_shards(df, f"{tmp_path}/s", 7, seed=1)
    got = sharding.read_shards(spark, f"{tmp_path}/s")
    assert set(got.columns) == {"doc_id", "text", "c0", "slot", "shard"}
    got = got.collect()
    check_shards(got, 7)
    assert Counter((r["doc_id"], r["text"]) for r in got) == Counter(rows)
    copies = Counter(r["shard"] for r in got if r["text"] == "same")
    assert len(copies) >= 4  # equal rows are spread like others


def test_shuffle_is_uniform_over_seeds(spark):
    """Every row lands in every shard about equally often, over many draws."""
    df = spark.range(12).withColumnRenamed("id", "doc_id").coalesce(1)
    at, seeds = Counter(), 24
    for seed in range(seeds):
        got = {r["doc_id"]: r["shard"] for r in sharding.uniform_shards(df, ["doc_id"], 3, seed, partitions=4).collect()}
        at.update((d, s) for d, s in got.items())
    assert all(abs(at[d, s] - seeds / 3) < 4 * (seeds * 2 / 9) ** 0.5 for d in range(12) for s in range(3))


def test_hypergeometric_draws_follow_the_law():
    import random

    rng = random.Random(3)
    draws = [sharding.hypergeometric(rng, 30, 70, 20) for _ in range(20_000)]
    assert abs(np.mean(draws) - 6) < 0.05 and abs(np.var(draws) - 20 * 0.3 * 0.7 * 80 / 99) < 0.12
    m = sharding.communication_matrix([5, 0, 9, 6], [7, 7, 6], 1)
    assert [sum(x) for x in m] == [5, 0, 9, 6] and [sum(x) for x in zip(*m)] == [7, 7, 6]


def slow_winnow(text, k, w):
    if not text:
        return []
    n = max(1, len(text) - k + 1)
    size = k if len(text) >= k else 1 << (len(text).bit_length() - 1)
    n = len(text) - size + 1
    hashes = [int(winnowing.winnow(text[i : i + size], size, 1).hashes[0]) for i in range(n)]
    chosen = set()
    for i in range(max(1, n - w + 1)):
        part = hashes[i : i + w]
        chosen.add(i + max(j for j, h in enumerate(part) if h == min(part)))
    return [(hashes[i], i) for i in sorted(chosen)]


def test_winnowing_chooses_the_rightmost_minimum():
    rng = np.random.default_rng(2)
    for n in (1, 3, 7, 8, 20, 300):
        text = "".join(rng.choice(list("abç"), n))
        got = winnowing.winnow(text, 4, 8)
        assert list(zip(got.hashes.tolist(), got.positions.tolist())) == slow_winnow(text, 4, 8)


def test_near_copies_among_short_texts_are_seen():
    rng = np.random.default_rng(5)

    def text(n):
        return "".join(rng.choice(list("etaoinshrdlu "), n))

    likes = []
    for n in rng.integers(60, 200, 300).tolist():
        one = text(n)
        likes.append(winnowing.winnow(one).likeness(winnowing.winnow(one[: n - n // 3] + text(n // 3))))
    assert 0 < min(likes) and max(likes) < 1 and np.std(likes) < 0.12
    for _ in range(200):
        shared = text(winnowing.GRAM + winnowing.WINDOW - 1)
        a, b = (winnowing.winnow(text(150) + shared + text(150)) for _ in range(2))
        assert len(shared) < 32 and np.isin(a.hashes, b.hashes).any()


def slow_edits(docs):
    order = sorted(docs, key=lambda d: (d is not None, d), reverse=True)
    out = {}
    for i, d in enumerate(order):
        text, after = docs[d] or "", docs[order[(i + 1) % len(order)]] or ""
        cut = len(text) // 3
        edited = text[: len(text) - cut] + after[:cut]
        f, g, h = (winnowing.winnow(x) for x in (text, edited, after))
        out[d] = (len(text), hashlib.sha256(edited.encode()).hexdigest(), f.text(), g.text(), f.likeness(g), f.likeness(h))
    return out


@pytest.mark.parametrize("parts", [1, 7, None])
def test_edited_fingerprints(spark, docs, parts):
    rows = winnowing.edited_fingerprints(spark.read.parquet(f"{SF}/documents.parquet"), parts).drop("n_hashes").collect()
    assert {r[0]: tuple(r[1:]) for r in rows} == slow_edits({d: t for d, (t, _) in docs.items()})


def test_edited_fingerprints_of_odd_rows(spark, odd, empty):
    rows = winnowing.edited_fingerprints(odd, 4).drop("n_hashes").collect()
    assert {r[0]: tuple(r[1:]) for r in rows} == slow_edits({r["doc_id"]: r["text"] for r in odd.collect()})
    assert winnowing.edited_fingerprints(empty, 4).collect() == []
    one = spark.createDataFrame([(5, "abcdef")], "doc_id long, text string")
    assert [(r["n_chars"], r["near_next"]) for r in winnowing.edited_fingerprints(one, 4).collect()] == [(6, 1.0)]


def test_language_is_right_on_held_out_rows(spark, docs):
    sf = "/root/testdata/sf0.01"
    rows = queries.op5_compression_language(spark, sf).collect()
    lang = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang").collect()}
    assert len(rows) == len(lang) and all(0 <= r["score"] <= 1 for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert {r["held_out"] for r in rows} == {zlib.crc32(str(d).encode()) % 5 == 0 for d in lang}
    right = np.mean([r["lang_pred"] == lang[r["doc_id"]] for r in held])
    assert right >= 0.95, right


def test_language_of_odd_rows(spark, odd, empty):
    model = {"aa": b"word word same text", "bb": "çà here".encode()}
    got = {r["doc_id"]: r for r in langid.predict(odd, model).collect()}
    assert {d for d, r in got.items() if r["lang_pred"] == "und"} == {0, 1, 6, None}
    assert langid.predict(empty, model).collect() == [] and langid.fit(empty) == {}
    assert {r["lang_pred"] for r in langid.predict(odd, {}).collect()} == {"und"}
