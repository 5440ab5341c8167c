"""Collocations, turn repair and exact duplicates against brute force, with nulls, ties, empty tables and clashing columns."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from ratelens.llm import content_sort, phrases, queries, turn_repair

SF = "/root/testdata/sf0.001"


# Exact duplicates

def slow_duplicates(rows, keep=max):
    groups = defaultdict(list)
    for doc, text in rows:
        groups[text or ""].append(doc)
    out = Counter()
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        best = keep(known) if known else None
        for n, i in enumerate(sorted(ids, key=lambda i: (i is None, i))):
            stays = i == best and (n == 0 or sorted(ids, key=lambda i: (i is None, i))[n - 1] != i)
            out[(i, best, len(ids), stays, hashlib.sha256(text.encode()).hexdigest())] += 1
    return out


@pytest.mark.parametrize("keep", ["largest", "smallest"])
def test_duplicates(spark, keep):
    rng = random.Random(3)
    rows = [(i, rng.choice(["a", "A", "", None, "same beginning of many texts that is long, then " + str(i % 7), "x" * 100_000])) for i in range(300)]
    rows += [(7, "a"), (7, "a"), (None, "a"), (None, "only"), (None, "only"), (900, "hot")] + [(1000 + i, "hot") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = Counter(tuple(r) for r in content_sort.mark(docs, keep=keep).collect())
    assert got == slow_duplicates(rows, max if keep == "largest" else min)


def test_duplicates_after_normalising(spark):
    from pyspark.sql import functions as F

    docs = spark.createDataFrame([(1, "A b"), (2, "a  B"), (3, "c")], "doc_id long, text string")
    got = content_sort.mark(docs, normalise=lambda t: F.regexp_replace(F.lower(t), r"\s+", " ")).collect()
    assert sorted((r["doc_id"], r["keep_id"], r["kept"]) for r in got) == [(1, 2, False), (2, 2, True), (3, 3, True)]


def test_duplicates_of_empty_table_and_clashing_columns(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert content_sort.mark(empty).collect() == []
    clash = spark.createDataFrame([(1, "a", 5, 6, "x"), (2, "a", 5, 6, "y")], "doc_id long, text string, hash int, salt int, keep_id string")
    assert sorted(tuple(r)[:4] for r in content_sort.mark(clash).collect()) == [(1, 2, 2, False), (2, 2, 2, True)]


def test_hot_text_is_dealt_over_partitions(spark):
    """One text with a third of the rows is in several partitions of the sort, and sorted without another exchange."""
    docs = spark.range(3000).selectExpr("id as doc_id", "case when id % 3 = 0 then 'hot' else concat('t', id) end as text")
    got = content_sort.mark(docs).collect()
    assert {(r["keep_id"], r["group_size"]) for r in got if r["doc_id"] % 3 == 0} == {(2997, 1000)}
    assert sum(r["kept"] for r in got) == 2001


# Turn repair

def every_repair(rows, faults):
    """(cost, audit, turns) of all edits with at most two insertions in a row."""
    acts = []
    for (role, text), fault in zip(rows, faults):
        late = 3 if fault == "truncated" else 0
        can = [("D", 4, None)]
        if fault not in ("blank", "duplicate"):
            can += [("K", late, (role, text)), ("R", 3 + late, ("user", text)), ("R", 3 + late, ("assistant", text))]
        acts.append(can)
    added = [[("I", 3, t) for t in ts] for n in range(3) for ts in itertools.product([("user", ""), ("assistant", "")], repeat=n)]
    for picks in itertools.product(*[x for a in acts for x in (added, [[c] for c in a])], added):
        edits = [e for pick in picks for e in pick]
        turns = [t for _, _, t in edits if t is not None]
        if re.fullmatch("(s?(ua)+)?", "".join(role[:1] or "?" for role, _ in turns)):
            yield sum(c for _, c, _ in edits), "".join(e for e, _, _ in edits), turns


def test_repair_is_the_cheapest_and_first(spark):
    rng = random.Random(1)
    for _ in range(60):
        rows = [(rng.choice(["user", "assistant", "system", "tool", ""]), rng.choice(["", "One.", "Two", "Three!", " \t"])) for _ in range(rng.randrange(4))]
        found = turn_repair.faults(rows)
        cost, audit, turns = min(every_repair(rows, found), key=lambda r: r[:2])
        got = turn_repair.repair(rows, found)
        assert (got.cost, got.audit, got.turns) == (cost, audit, turns), rows


def slow_path(rows, faults):
    """Cheapest (cost, audit, turns) as text, by the rows done and the initials so far, for conversations of any length."""
    follow = {"": "su", "s": "u", "u": "a", "a": "u"}
    names = {"u": "user", "a": "assistant"}
    ends = {"": (0, "", ()), "a": (0, "", ()), "s": None, "u": None}

    def inserted(best):
        for _ in range(2):
            for s in best:
                for nxt in follow[s].replace("s", ""):
                    if best[nxt] is not None:
                        c, a, t = best[nxt]
                        new = (c + 3, "I" + a, ((names[nxt], ""),) + t)
                        best[s] = new if best[s] is None else min(best[s], new, key=lambda x: x[:2])
        return best

    best = inserted(dict(ends))
    for (role, text), fault in reversed(list(zip(rows, faults))):
        late, new = 3 if fault == "truncated" else 0, {}
        for s in follow:
            can = []
            if best[s] is not None:
                can.append((best[s][0] + 4, "D" + best[s][1], best[s][2]))
            for nxt in follow[s] if fault not in ("blank", "duplicate") else "":
                if best[nxt] is not None:
                    c, a, t = best[nxt]
                    if role[:1] == nxt:
                        can.append((c + late, "K" + a, ((role, text),) + t))
                    if nxt != "s":
                        can.append((c + 3 + late, "R" + a, ((names[nxt], text),) + t))
            new[s] = min(can, key=lambda x: x[:2]) if can else None
        best = inserted(new)
    return best[""]


@pytest.mark.parametrize("sf", [SF, "/root/testdata/sf0.01"])
def test_repair_of_the_table(spark, sf):
    talk = defaultdict(list)
    for c, t, role, text in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect():
        talk[c].append((t, role if role is not None else " ", text if text is not None else " "))
    want = {}
    for conv, said in talk.items():
        rows = []
        for t, role, text in said:
            fault = zlib.crc32(f"{conv}:{' ' if t is None else t}".encode()) % 20
            text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
            rows += [(t, "user" if fault == 4 else role, text)] * {0: 0, 3: 2}.get(fault, 1)
        rows.sort(key=lambda r: (r[0] is not None, r))
        turns, plain = [t for t, _, _ in rows if t is not None], [r[1:] for r in rows]
        found = turn_repair.faults(plain)
        cost, audit, kept = slow_path(plain, found)
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(plain, plain[1:]))
        digest = hashlib.sha256("\n".join(f"{a}:{b}" for a, b in kept).encode()).hexdigest()
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        want[conv] = (gaps, *(found.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, digest)
    got = queries.op12_weighted_turn_repair(spark, sf).collect()
    assert {r["conv_id"]: tuple(r)[1:] for r in got} == want and len(got) == len(want)


def test_repair_of_nulls_ties_and_long_conversations(spark):
    kind = "conv_id long, turn long, role string, text string, rows int, audit string"
    rows = [(1, None, "system", "S."), (1, 0, "user", "Q."), (1, 0, "user", "Q."), (1, 2, "assistant", "A."), (2, None, None, None), (None, 5, "assistant", "Alone")]
    long = [(3, i, "user" if i % 2 == 0 else "assistant", f"Text {i}." if i % 97 else "") for i in range(1500)]
    got = turn_repair.repair_conversations(spark.createDataFrame([(*r, 9, "x") for r in rows + long], kind)).collect()
    by_id = {r["conv_id"]: r for r in got}
    assert (by_id[1]["audit"], by_id[1]["duplicate"], by_id[1]["gaps"], by_id[1]["cost"]) == ("KKDK", 1, 1, 4)
    assert (by_id[2]["audit"], by_id[2]["blank"], by_id[2]["cost"], by_id[2]["repaired"]) == ("D", 1, 4, [])
    # Deleting costs 4, an inserted user 3 and the missing end 3 more.
    assert (by_id[None]["audit"], by_id[None]["truncated"], by_id[None]["cost"]) == ("D", 1, 4)
    plain = [(r[2], r[3]) for r in long]
    assert (by_id[3]["cost"], by_id[3]["audit"]) == slow_path(plain, turn_repair.faults(plain))[:2]
    assert turn_repair.repair_conversations(spark.createDataFrame([], kind)).collect() == []


# Collocations

def slow_collocations(rows, longest, least, top):
    counts, total = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", low):
            words = re.findall("[^ \t]+", piece)
            total[lang] += len(words)
            for i in range(len(words)):
                for k in range(1, min(longest, len(words) - i) + 1):
                    counts[lang][tuple(words[i : i + k])] += 1
    out = []
    for lang, c in counts.items():
        often = {p: a for p, a in c.items() if a >= least}
        longer = defaultdict(int)
        for p, a in often.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    longer[p[i : i + k]] = max(longer[p[i : i + k]], a)
        scored = []
        for p, a in often.items():
            if len(p) > 1 and longer[p] < a:
                score, k = min((1000 * a * total[lang] // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p)))
                scored.append((-score, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, total[lang], -score))
    return sorted(out)


def some_texts(n=400):
    rng = random.Random(8)
    common = ["new york city hall", "in the end", "ça va bien", "a\tb  c"]
    for i in range(n):
        words = [rng.choice(["the", "of", "Y", "w" + str(rng.randrange(60)), rng.choice(common), "x" * 70])for _ in range(rng.randrange(40))]
        yield rng.choice(["en", "en", None, "de"]), rng.choice([" ", " ", ". "]).join(words).replace("w7", ";w7")
    yield "en", None
    yield "en", ""
    yield "de", " .. \n\t,"
    yield "en", "the of " * 5000  # a long text of one phrase
    yield "und", "z" * 200_000 + " in the end"


@pytest.mark.parametrize("longest, chunk", [(5, 32), (5, 2), (2, 3), (3, 1)])
def test_collocations(spark, longest, chunk):
    rows = list(some_texts())
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "lang string, text string, n int, phrase string").repartition(3)
    got = phrases.collocations(docs, longest=longest, least=5, top=50, chunk=chunk).collect()
    assert sorted(tuple(r) for r in got) == slow_collocations(rows, longest, 5, 50)


def test_collocations_hold_with_any_filter(spark, monkeypatch):
    """A bitmap that is nearly full lets rare pairs through, and the result is the same."""
    monkeypatch.setattr(phrases, "SLOTS", 1)
    rows = list(some_texts(150))
    docs = spark.createDataFrame(rows, "lang string, text string")
    got = phrases.collocations(docs, least=3, top=100).collect()
    assert sorted(tuple(r) for r in got) == slow_collocations(rows, 5, 3, 100)


def test_parse_covers_every_text_once():
    texts = [(t or "").encode() for _, t in some_texts(80)]
    for chunk in (1, 2, 32):
        owner, cuts, last = phrases._chunks_of(texts, 4, chunk)
        back = defaultdict(list)
        for o, c, e in zip(owner, cuts, last):
            words = c.split(b" ")
            back[o] += words if e else words[:-4]
        assert [back[i] for i in range(len(texts))] == [phrases.tokens(t) for t in texts]


def test_collocations_of_empty_table(spark):
    assert phrases.collocations(spark.createDataFrame([], "lang string, text string")).collect() == []
