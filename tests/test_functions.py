import json
import math
import random

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratelens.functions import labels, text
from ratelens.functions.canonical import canonical_json, digests, raw_schema
from ratelens.functions.lookup import dictionary_lookup
from ratelens.functions.numbers import decimal_text, round_half_even_exact
from ratelens.functions.sentiment import Rules, plain_compound, rule_compound


def one(df):
    return df.collect()[0]


def test_words_match_python_split(spark):
    cases = ["", "  ", "a b", "\ta b c\x1cd\n", "x", None, "é  ü　z"]
    got = spark.createDataFrame([(c,) for c in cases], "t string").select(text.words(F.col("t")).alias("w")).collect()
    assert [r["w"] for r in got] == [(c or "").split() for c in cases]


def test_word_count_of_null_is_zero(spark):
    assert one(spark.sql("select cast(null as string) t").select(text.word_count(F.col("t")).alias("n")))["n"] == 0


def test_label_parsers(spark):
    cases = {
        "Positive": (1, 1), "neg": (0, None), "positive or negative": (1, None), "1": (None, 1), "maybe": (None, None),
        "": (None, None), "POS\nnegative": (1, 0), "It is negative.": (0, 0), "0 or 1": (None, None), None: (None, None),
        "\n positive": (1, 1), "x" * 60 + " positive": (1, None),
    }
    df = spark.createDataFrame([(k,) for k in cases], "a string").select(
        "a", labels.parse_strict(F.col("a")).alias("s"), labels.parse_window(F.col("a")).alias("w"))
    assert {r["a"]: (r["s"], r["w"]) for r in df.collect()} == cases


def test_rounding_equals_correct_decimal_rounding(spark):
    rng = random.Random(3)
    xs = [4.0625, 2.675, 0.5, 1.5, -0.0625, 4.6125, 1e-9, 0.0, -2.5]
    xs += [rng.randint(1, 400) / rng.randint(1, 400) for _ in range(3000)] + [rng.randint(0, 2000) / 16 for _ in range(500)]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    for d in (2, 3, 4):
        got = df.select("x", F.expr(round_half_even_exact("x", d)).alias("r")).collect()
        assert all(r["r"] == round(r["x"], d) for r in got)


def test_decimal_text(spark):
    df = spark.createDataFrame([(0.0001,), (3.0,), (2.5,), (-0.061,), (100.0,)], "x double")
    assert [r[0] for r in df.select(F.expr(decimal_text("x", 4))).collect()] == ["0.0001", "3.0", "2.5", "-0.061", "100.0"]


SCHEMA = T.StructType([
    T.StructField("b", T.StringType()), T.StructField("a", T.DoubleType()),
    T.StructField("n", T.StructType([T.StructField("z", T.IntegerType()), T.StructField("k", T.ArrayType(T.StringType()))])),
])


def test_canonical_json_equals_sorted_compact_dump(spark):
    docs = [
        {"b": "plain", "a": 0.0001, "n": {"z": 1, "k": ["x", None]}},
        {"b": "é \"quote\" \\ tab\t emoji \U0001f600", "a": None, "n": {"z": None, "k": []}},
        {"b": None, "a": 3.0, "n": None},
        {"b": "tiny", "a": 1.5e-07, "n": None}, {"b": "huge", "a": 1e20, "n": None}, {"b": "big", "a": 12345678.5, "n": None},
        {"b": "", "a": -12.5, "n": {"z": 7, "k": None}},
    ]
    path = spark.createDataFrame([(json.dumps(d),) for d in docs], "v string")
    raw = path.select(F.from_json("v", raw_schema(SCHEMA)).alias("r")).select("r.*")
    got = [r[0] for r in raw.select(F.expr(canonical_json(SCHEMA))).collect()]
    assert got == [json.dumps(d, sort_keys=True, separators=(",", ":")) for d in docs]


def test_digests_are_hex(spark):
    d = one(spark.sql("select '{\"a\":1}' t").select(F.expr(digests("t")).alias("d")))["d"]
    assert len(d["sha256"]) == 64 and len(d["sha512"]) == 128


def test_dictionary_lookup(spark):
    entries = {f"w{i}": float(i) for i in range(500)} | {"é": -1.0}
    find = dictionary_lookup(entries)
    df = spark.createDataFrame([(k, v) for k, v in entries.items()] + [("absent", None), (None, None)], "t string, v double")
    assert df.filter(~find(F.col("t")).eqNullSafe(F.col("v"))).count() == 0


def test_dictionary_may_be_large(spark):
    find = dictionary_lookup({f"w{i}": float(i) for i in range(102_154)})
    df = spark.createDataFrame([("w102153",), ("w0",), ("x",)], "t string")
    assert [r[0] for r in df.select(find(F.col("t"))).collect()] == [102153.0, 0.0, None]


def test_plain_compound_edge_cases(spark):
    df = spark.createDataFrame([(None,), ("",), ("good good",), ("GOOD, bad!",), ("nothing here",)], "t string")
    got = [r[0] for r in df.select(plain_compound(F.col("t"), {"good": 1.5, "bad": -1.5})).collect()]
    assert got == [0.0, 0.0, round(3 / math.sqrt(24), 4), 0.0, 0.0]


def read_emoji(body, emoji):
    out, space = "", True
    for c in body or "":
        if c in emoji:
            out += ("" if space else " ") + emoji[c]
            space = False
        else:
            out += c
            space = c == " "
    return out


def brute_force(body, rules):
    """The published rules, word by word."""
    body = read_emoji(body, rules.emoji)
    punct = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
    ws = [w if len(w.strip(punct)) <= 2 else w.strip(punct) for w in body.split()]
    low = [w.lower() for w in ws]
    caps = [w.isupper() for w in ws]
    mixed = any(caps) and not all(caps)
    total = 0.0
    cut = low.index(rules.contrast) if rules.contrast in low else None
    back = lambda i, k: low[i - k] if i - k >= 0 else None
    for i, w in enumerate(low):
        if w in rules.boosters or w not in rules.lexicon or tuple(low[i : i + 2]) == rules.hedge:
            continue
        v = rules.lexicon[w]
        if w == rules.refusal and i + 1 < len(low) and low[i + 1] in rules.lexicon:
            v = 0.0
        if rules.refusal in (back(i, 1), back(i, 2)) or (back(i, 3) == rules.refusal and back(i, 1) in rules.refusal_joined):
            v = rules.lexicon[w] * -0.74
        if mixed and caps[i]:
            v += 0.733 if v > 0 else -0.733
        for k, damp in ((1, 1.0), (2, 0.95), (3, 0.9)):
            p = back(i, k)
            if p is None or p in rules.lexicon:
                continue
            if p in rules.boosters:
                s = rules.boosters[p] * (-1 if v < 0 else 1)
                if mixed and caps[i - k]:
                    s += 0.733 if v > 0 else -0.733
                v += s * damp
            negated = p in rules.negators or "n't" in p
            without, doubt = rules.certain
            if k == 1:
                v *= -0.74 if negated else 1
            elif k == 2:
                if p == rules.stress and back(i, 1) in rules.stress_with:
                    v *= 1.25
                elif (p, back(i, 1)) != (without, doubt) and negated:
                    v *= -0.74
            else:
                if (p == rules.stress and back(i, 2) in rules.stress_with) or back(i, 1) in rules.stress_with:
                    v *= 1.25
                elif not (p == without and doubt in (back(i, 1), back(i, 2))) and negated:
                    v *= -0.74
                found = [" ".join(low[i - a : i + b]) for a, b in ((1, 1), (2, 1), (2, 0), (3, 0), (3, -1))]
                for f in found:
                    if f in rules.idioms:
                        v = rules.idioms[f]
                        break
                for ahead in (2, 3):
                    if i + ahead <= len(low):
                        v = rules.idioms.get(" ".join(low[i : i + ahead]), v)
                for f in (found[3], found[4], found[2]):
                    v += rules.phrase_boosters.get(f, 0)
        if back(i, 1) == rules.least and rules.least not in rules.lexicon and (i < 2 or low[i - 2] not in rules.least_after):
            v *= -0.74
        if cut is not None and i != cut:
            v *= 0.5 if i < cut else 1.5
        total += v
    q = body.count("?")
    push = min(body.count("!"), 4) * 0.292 + (0 if q <= 1 else q * 0.18 if q <= 3 else 0.96)
    total += push if total > 0 else -push if total < 0 else 0
    return round(max(-1, min(1, total / math.sqrt(total * total + 15))), 4)


def test_phrases_equal_brute_force(spark):
    """Idioms, refusals, stress, certainty, least, hedges and emoji in every mixture of a small vocabulary."""
    lexicon = {"good": 1.9, "bad": -2.5, "no": -1.2, "ass": -2.5, "heart": 3.2, "kind": 2.4, "death": -2.9, "doubt": -1.5, "die": -2.9, "like": 1.5}
    emoji = {"\U0001f600": "grinning face good", "\U0001f494": "broken heart", "\u2764": "red heart"}
    rng = random.Random(9)
    pool = [*lexicon, "never", "so", "this", "without", "or", "nor", "least", "at", "very", "of", "sort", "just", "enough", "the", "bomb", "to", "for",
            "NO", "Never", "SO", "broken", "beating", "bus", "stop", "yeah", "right", "kiss", "isn't", "but", "\U0001f600", "a\U0001f494", "\u2764\u2764!", "x", "(bad)", "ass!!"]
    texts = ["no good", "no good or bad", "never so good", "it is never this bad thing", "without a doubt good", "without doubt good", "least good", "at least good",
             "the least bad", "that is the shit man", "one of the kind of good", "x y z kiss of death", "a good heart to die for", "so good", "it was so good", "\U0001f600", " \U0001f494 ", "a\U0001f600\U0001f600b", "no", "NO way good"]
    texts += [" ".join(rng.choice(pool) for _ in range(rng.randint(1, 14))) for _ in range(1200)]
    for extra in ({}, {"doubt": 0.0}):
        rules = Rules({k: v for k, v in lexicon.items() if k not in extra}, emoji=emoji)
        df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
        got = {r["i"]: r["s"] for r in rule_compound(df, "t", rules, "s").select("i", "s").collect()}
        assert [t for i, t in enumerate(texts) if abs(got[i] - brute_force(t, rules)) > 1e-9] == []


def test_rule_compound_equals_brute_force(spark):
    rules = Rules({"good": 1.9, "great": 3.1, "bad": -2.5, "awful": -2.0, "fine": 0.8})
    rng = random.Random(5)
    pool = ["good", "great", "bad", "awful", "fine", "very", "not", "but", "the", "food", "barely", "isn't", "GOOD", "VERY",
            "BAD!", "(good)", "good?", "??", "!!!", "never", "so", ":)", "no,"]
    texts = [None, "", "GOOD", "not good", "very good!!!!!", "good but bad"]
    texts += [" ".join(rng.choice(pool) for _ in range(rng.randint(1, 25))) for _ in range(400)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r["i"]: r["s"] for r in rule_compound(df, "t", rules, "s").select("i", "s").collect()}
    assert all(abs(got[i] - brute_force(t, rules)) < 1e-9 for i, t in enumerate(texts))
