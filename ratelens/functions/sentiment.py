"""Lexicon sentiment in [-1, 1], computed inside the row (no shuffle of text).

Rules after Hutto & Gilbert (2014): word valence, degree modifiers damped by distance,
negation within three words, a contrastive word, capitals and punctuation emphasis; phrases that look
back and ahead from a word: idioms, modifiers of several words, "no" before a word, "never so",
"without doubt", "least", "kind of"; and emoji read as their names.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratelens.functions.lookup import dictionary_lookup, text_lookup
from ratelens.functions.text import alpha_tokens, words

# Fixed values of the published rule set.
ALPHA = 15.0
NEGATION = -0.74
CAPITALS = 0.733
DAMPING = (1.0, 0.95, 0.9)
BEFORE_CONTRAST = 0.5
AFTER_CONTRAST = 1.5
EXCLAMATION = 0.292
EXCLAMATION_MAX = 4
QUESTION = 0.18
QUESTION_MANY = 0.96
BOOST = 0.293

# Degree modifiers, negators and the contrastive word of English.
BOOSTERS = {
    **dict.fromkeys(
        "absolutely amazingly completely considerably decidedly deeply enormously entirely especially "
        "exceptionally extremely fully greatly highly hugely incredibly intensely majorly more most "
        "particularly purely quite really remarkably so substantially thoroughly totally tremendously "
        "unbelievably unusually utterly very".split(), BOOST),
    **dict.fromkeys(
        "almost barely hardly less little marginally occasionally partly scarcely slightly somewhat".split(), -BOOST),
}
NEGATORS = frozenset(
    "aint arent cannot cant couldnt darent didnt doesnt dont hadnt hasnt havent isnt mightnt mustnt neither "
    "never none nope nor not nothing nowhere oughtnt rarely seldom shant shouldnt uhuh wasnt werent without "
    "wont wouldnt despite".split()
)
CONTRAST = "but"

# English phrases with a valence of their own, and degree modifiers of more than one word.
IDIOMS = {
    "the shit": 3.0, "the bomb": 3.0, "bad ass": 1.5, "badass": 1.5, "bus stop": 0.0, "yeah right": -2.0, "kiss of death": -1.5,
    "to die for": 3.0, "beating heart": 3.1, "broken heart": -2.9,
}
PHRASE_BOOSTERS = {"kind of": -BOOST, "sort of": -BOOST, "just enough": -BOOST}

# The word that refuses what follows, and the words that carry it on; "never so", "never this" and their gain;
# "without doubt", which does not negate; "least", unless after one of two words; "kind of", which says nothing itself.
REFUSAL, REFUSAL_JOINED = "no", ("or", "nor")
STRESS, STRESS_WITH, STRESS_GAIN = "never", ("so", "this"), 1.25
CERTAIN = ("without", "doubt")
LEAST, LEAST_AFTER = "least", ("at", "very")
HEDGE = ("kind", "of")

# ASCII punctuation.
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


@dataclass(frozen=True)
class Rules:
    """Word lists. `lexicon` is always supplied by the caller; the rest default to English."""

    lexicon: dict[str, float]
    boosters: dict[str, float] = field(default_factory=lambda: dict(BOOSTERS))
    negators: frozenset[str] = NEGATORS
    contrast: str = CONTRAST
    idioms: dict[str, float] = field(default_factory=lambda: dict(IDIOMS))
    phrase_boosters: dict[str, float] = field(default_factory=lambda: dict(PHRASE_BOOSTERS))
    refusal: str = REFUSAL
    refusal_joined: tuple[str, ...] = REFUSAL_JOINED
    stress: str = STRESS
    stress_with: tuple[str, ...] = STRESS_WITH
    certain: tuple[str, str] = CERTAIN
    least: str = LEAST
    least_after: tuple[str, ...] = LEAST_AFTER
    hedge: tuple[str, str] = HEDGE
    #: Emoji (one code point each) to the words they are read as; none by default.
    emoji: dict[str, str] = field(default_factory=dict)


def normalise(total: Column) -> Column:
    score = total / F.sqrt(total * total + F.lit(ALPHA))
    return F.greatest(F.lit(-1.0), F.least(F.lit(1.0), score))


def plain_compound(text: Column, lexicon: dict[str, float]) -> Column:
    """Sum of word valences over a-z tokens, squashed into [-1, 1], four digits. Null text scores 0."""
    find = dictionary_lookup(lexicon)
    valences = F.transform(alpha_tokens(text), lambda t: F.coalesce(find(t), F.lit(0.0)))
    # The squashing runs in the fold's last step: outside, it would repeat the fold per mention of its result.
    # The constant keeps the column non-nullable: a later null filter then folds away instead of scoring again.
    return F.coalesce(F.round(F.aggregate(valences, F.lit(0.0), lambda acc, v: acc + v, normalise), 4), F.lit(0.0))


def _is_upper(word: Column) -> Column:
    return (F.upper(word) == word) & (F.lower(word) != word)


def spoken(text: Column, emoji: dict[str, str]) -> Column:
    """The text with emoji as their words, set apart from what stands before them. Texts without any are left as they are."""
    name = text_lookup(emoji)
    chars = F.regexp_extract_all(text, F.lit("(?s)."), F.lit(0))

    def read(all_: Column) -> Column:
        def one(c: Column, i: Column) -> Column:
            apart = F.when((i == 0) | (F.get(all_, i - 1) == " "), "").otherwise(" ")
            return F.when(name(c).isNotNull(), F.concat(apart, name(c))).otherwise(c)

        return F.array_join(F.transform(all_, one), "")

    marks = "[" + "".join(f"\\x{{{ord(c):X}}}" for c in emoji) + "]"
    said = F.get(F.transform(F.array(chars), read), F.lit(0))  # bound once: the characters are not cut out per mention
    return F.when(F.regexp_like(text, F.lit(marks)), said).otherwise(text)


def _phrase(*parts: Column) -> Column:
    """Words with blanks between; null if one is missing."""
    out = parts[0]
    for p in parts[1:]:
        out = F.concat(out, F.lit(" "), p)
    return out


def _telling_words(rules: Rules) -> list[str]:
    """One word of every phrase, the longest: a text without any of them holds none of the phrases."""
    return sorted({max(p.split(), key=len) for p in (*rules.idioms, *rules.phrase_boosters)})


def rule_compound(df: DataFrame, text: str, rules: Rules, out: str = "vader_compound") -> DataFrame:
    """Add the full rule-based score as column `out`, rounded to four digits."""
    find = dictionary_lookup(rules.lexicon)
    valence = dictionary_lookup({t: v for t, v in rules.lexicon.items() if t not in rules.boosters})
    boost = dictionary_lookup(rules.boosters)
    negate = dictionary_lookup(dict.fromkeys(rules.negators, 1.0))
    idiom, phrase_boost = dictionary_lookup(rules.idioms), dictionary_lookup(rules.phrase_boosters)
    without, doubt = rules.certain
    hedge, hedge_of = rules.hedge

    # Words lose the punctuation around them unless at most two characters would be left.
    cores = F.transform("_w", lambda w: F.btrim(w, F.lit(PUNCTUATION)))
    plain = F.transform(cores, lambda c, i: F.lower(F.when(F.length(c) <= 2, F.get("_w", i)).otherwise(c)))
    hits = F.transform("_low", lambda t, i: F.struct(i.alias("i"), valence(t).alias("v")))
    said = spoken(F.col(text), rules.emoji) if rules.emoji else F.col(text)
    staged = (
        df.withColumn("_said", said)
        .withColumn("_w", words(F.col("_said")))
        .withColumn("_low", plain)
        .withColumn("_mixed", F.exists("_w", _is_upper) & ~F.forall("_w", _is_upper))
        .withColumn("_contrast", F.array_position("_low", rules.contrast) - 1)
        .withColumn("_hits", F.filter(hits, lambda h: h["v"].isNotNull()))
        .withColumn("_phrases", F.arrays_overlap("_low", F.array(*[F.lit(w) for w in _telling_words(rules)]).cast("array<string>")))
    )
    w, low, mixed, cut = F.col("_w"), F.col("_low"), F.col("_mixed"), F.col("_contrast")

    def at(h: Column, step: int) -> Column:
        return F.get(low, h["i"] + step)

    def known(word: Column) -> Column:
        return find(word).isNotNull()

    def base(h: Column) -> Column:
        """Valence of the word itself: refused by a word before it, nothing if it only refuses the next one, louder in capitals."""
        gone = (at(h, 0) == rules.refusal) & known(at(h, 1))
        refused = (at(h, -1) == rules.refusal) | (at(h, -2) == rules.refusal) | ((at(h, -3) == rules.refusal) & at(h, -1).isin(*rules.refusal_joined))
        v = F.when(refused, h["v"] * NEGATION).when(gone, 0.0).otherwise(h["v"])
        push = F.when(mixed & _is_upper(F.get(w, h["i"])), F.lit(CAPITALS)).otherwise(0.0)
        return F.get(F.transform(F.array(v), lambda x: x + F.when(x > 0, push).otherwise(-push)), F.lit(0))

    def scored(h: Column) -> Column:
        def look_back(v: Column, k: Column) -> Column:
            prev, l1, l2 = F.get(low, h["i"] - k), at(h, -1), at(h, -2)
            caps = F.when(mixed & _is_upper(F.get(w, h["i"] - k)), CAPITALS).otherwise(0.0)
            damp = F.element_at(F.array(*[F.lit(d) for d in DAMPING]), k)
            step = F.when(boost(prev).isNotNull(), (F.when(v < 0, -boost(prev)).otherwise(boost(prev)) + F.when(v > 0, caps).otherwise(-caps)) * damp).otherwise(0.0)
            # "never" two or three words back stresses with "so" or "this" after it; three words back, so does "so" or
            # "this" right before the word alone, as in the published implementation.
            near = l1.isin(*rules.stress_with)
            stressed = ((k == 2) & (prev == rules.stress) & near) | ((k == 3) & (((prev == rules.stress) & l2.isin(*rules.stress_with)) | near))
            certain = (prev == without) & (((k == 2) & (l1 == doubt)) | ((k == 3) & ((l1 == doubt) | (l2 == doubt))))
            negated = negate(prev).isNotNull() | F.contains(prev, F.lit("n't"))
            factor = F.when(stressed, STRESS_GAIN).when(certain, 1.0).when(negated, NEGATION).otherwise(1.0)
            return F.when(prev.isNotNull() & ~known(prev), (v + step) * factor).otherwise(v)

        def look_around(v: Column) -> Column:
            """Phrases around a word that has three words before it, the first of them without a valence."""
            l3, l2, l1, own, f1, f2 = (at(h, s) for s in (-3, -2, -1, 0, 1, 2))
            phrases = [(own, f1, f2), (own, f1), (l1, own), (l2, l1, own), (l2, l1), (l3, l2, l1), (l3, l2)]
            value = F.coalesce(*[idiom(_phrase(*p)) for p in phrases], v)
            more = [F.coalesce(phrase_boost(_phrase(*p)), F.lit(0.0)) for p in ((l3, l2, l1), (l3, l2), (l2, l1))]
            open_ = l3.isNotNull() & ~known(l3)
            return F.when(F.col("_phrases") & open_, value + more[0] + more[1] + more[2]).otherwise(v)

        def not_least(v: Column) -> Column:
            least = (at(h, -1) == rules.least) & ~known(at(h, -1)) & ~F.coalesce(at(h, -2).isin(*rules.least_after), F.lit(False))
            return F.when(least, v * NEGATION).otherwise(v)

        v = F.aggregate(F.array(F.lit(1), F.lit(2), F.lit(3)), base(h), look_back, lambda x: not_least(look_around(x)))
        v = F.when((at(h, 0) == hedge) & (at(h, 1) == hedge_of), 0.0).otherwise(v)
        return (
            F.when((cut < 0) | cut.isNull() | (h["i"] == cut), v)
            .when(h["i"] < cut, v * BEFORE_CONTRAST)
            .otherwise(v * AFTER_CONTRAST)
        )

    total = F.aggregate(F.transform("_hits", scored), F.lit(0.0), lambda acc, v: acc + v)
    body = F.coalesce("_said", F.lit(""))
    marks = F.length(body) - F.length(F.replace(body, F.lit("!"), F.lit("")))
    asks = F.length(body) - F.length(F.replace(body, F.lit("?"), F.lit("")))
    push = F.least(marks, F.lit(EXCLAMATION_MAX)) * F.lit(EXCLAMATION) + (
        F.when(asks <= 1, 0.0).when(asks <= 3, asks * F.lit(QUESTION)).otherwise(QUESTION_MANY)
    )
    staged = staged.withColumn("_total", total).withColumn(
        "_total", F.col("_total") + F.signum("_total") * push
    )
    score = F.coalesce(F.round(normalise(F.col("_total")), 4), F.lit(0.0))
    return staged.withColumn(out, score).drop(
        "_said", "_w", "_low", "_mixed", "_contrast", "_hits", "_phrases", "_total"
    )


def normalised_stars(stars: Column) -> Column:
    """1..5 stars to -1..1."""
    return (stars.cast("double") - 3.0) / F.lit(2.0)


def divergence(compound: Column, stars: Column) -> Column:
    return F.abs(compound - normalised_stars(stars))


def divergence_flag(div: Column, threshold: float) -> Column:
    """1 strictly above the threshold, else 0; a missing score is not flagged."""
    return F.coalesce((div > F.lit(threshold)).cast("int"), F.lit(0))
