"""Personal data replaced by surrogates of the same kind.

Entities are found by one pattern per kind. All spellings of an entity have one canonical form (the digits of a phone
number, the lower-case address, the name without its title), and each canonical form gets one surrogate from a keyed hash:
digits for digits, letters for letters of the same script, names of the same gender and script from name parts. A family name
has one surrogate, alone after a title and in every full name. A surrogate is refused
if another entity has it or if it is itself an entity of the corpus; refused entities try again with the next hash. So
entities that differ stay different, and one entity has one surrogate in all documents. Each spelling is then rebuilt
with its own format: separators, brackets and capitals stay where they were, card numbers and
IBANs keep valid or invalid check digits.

Everything is built-in column functions. Entities are distinct rows keyed by their text, so that a frequent one is one row.
Null and empty texts stay as they are, and so does every text without an entity. Repeated rows get equal answers. Columns other than the text
are kept, whatever their names; those named `entities` or `kinds` are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratelens.llm import given_names
from ratelens.session import materialise

# Name parts of surrogates, and titles. Given names by gender. What is found as a name is in given_names.
FEMALE = ("Anna", "Clara", "Elena", "Emma", "Greta", "Ines", "Julia", "Laura", "Lucia", "Maria", "Marta", "Nora", "Olivia", "Paula", "Sarah", "Sofia")
MALE = ("Adam", "Bruno", "Carlos", "David", "Felix", "Henry", "Hugo", "James", "John", "Lucas", "Martin", "Michael", "Oscar", "Paul", "Peter", "Thomas")
FEMALE_TITLES = ("Mrs", "Ms", "Miss", "Madam", "Frau", "Madame", "Mademoiselle", "Señora", "Señorita")
MALE_TITLES = ("Mr", "Sir", "Herr", "Monsieur", "Señor")
OTHER_TITLES = ("Dr", "Prof", "Mx")
SURNAME_STARTS = ("Al", "Bar", "Cor", "Dal", "Er", "Fal", "Gar", "Hol", "Kel", "Lan", "Mar", "Nor", "Or", "Pel", "Ros", "Sel", "Tal", "Ver", "Wal", "Zan")
SURNAME_ENDS = ("bach", "berg", "dale", "dez", "feld", "ford", "gard", "hart", "ley", "man", "mont", "ner", "ric", "sen", "son", "stein", "ton", "vale", "well", "wick")

#: Given names and surname parts of surrogates in other scripts.
OTHER_SCRIPTS = {
    "Cyrillic": (("Анна", "Елена", "Ирина", "Мария", "Нина", "Ольга", "София", "Юлия"), ("Андрей", "Борис", "Виктор", "Иван", "Максим", "Олег", "Павел", "Юрий"),
                 ("Ал", "Бар", "Вер", "Гор", "Дал", "Зан", "Кор", "Лан", "Мар", "Нор", "Пел", "Рос", "Сел", "Тал", "Фал", "Хол"), ("берг", "вал", "енко", "зар", "кин", "лей", "монт", "нер", "рик", "сен", "тон", "ук")),
    "Greek": (("Άννα", "Ειρήνη", "Ελένη", "Ιωάννα", "Μαρία", "Σοφία"), ("Ανδρέας", "Γιώργος", "Κώστας", "Νίκος", "Πέτρος", "Σπύρος"),
              ("Αλ", "Βερ", "Γαρ", "Δαλ", "Ζαν", "Καλ", "Λαν", "Μαρ", "Νορ", "Παπ", "Ροδ", "Σελ", "Ταλ", "Φαλ"), ("άκης", "ίδης", "άτος", "έας", "ίνος", "όπουλος", "ώνης", "ούρης")),
}

_W = r"[\p{L}\p{N}]"
_NAME = r"\p{Lu}[\p{Ll}'’-]+"
_GIVEN = given_names.pattern((*given_names.of("f"), *given_names.of("m"), *FEMALE, *MALE))
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_TITLE = "|".join((*FEMALE_TITLES, *MALE_TITLES, *OTHER_TITLES))

#: Kind and pattern, in the order in which they are tried at a place where no word goes on. None has a group.
PATTERNS = (
    ("ip", rf"(?<!\.){_OCTET}(?:\.{_OCTET}){{3}}(?!\.?{_W})"),
    ("ssn", rf"(?<!-)\d{{3}}-\d{{2}}-\d{{4}}(?!{_W}|-\d)"),
    ("phone", rf"(?:\+\d{{1,3}}[ .-]?)?\(\d{{2,4}}\)[ .-]?\d{{3,4}}[ .-]?\d{{3,4}}(?!{_W})|\+\d{{1,3}}(?:[ .-]?\d{{2,4}}){{2,5}}(?!{_W})"
              rf"|(?<![.-])\d{{3}}[.-]\d{{3}}[.-]\d{{4}}(?!{_W}|[.-]\d)"),
    ("card", rf"(?<![.-])\d{{4}}(?:[ -]?\d{{4}}){{2}}[ -]?\d{{1,7}}(?!{_W})"),
    ("iban", rf"[A-Z]{{2}}\d{{2}}(?:[A-Z0-9]{{11,30}}|(?: [A-Z0-9]{{4}}){{3,7}}(?: [A-Z0-9]{{1,3}})?)(?!{_W})"),
    ("secret", rf"(?:AKIA[0-9A-Z]{{16}}|gh[pousr]_[A-Za-z0-9]{{30,}}|sk-[A-Za-z0-9_-]{{20,}}|(?=[A-Fa-f]*\d)(?=\d*[A-Fa-f])(?:[0-9a-f]{{32,128}}|[0-9A-F]{{32,128}}))(?!{_W})"),
    ("email", rf"(?<![._%+-]){_W}[\p{{L}}\p{{N}}._%+-]*+@(?:{_W}(?:[\p{{L}}\p{{N}}-]*{_W})?\.)+\p{{L}}{{2,}}(?!{_W})"),
    ("name", rf"(?=\p{{Lu}})(?:(?:{_TITLE})\.? {_NAME}(?: {_NAME})?|(?:{_GIVEN}) {_NAME})"),
)
_OF = dict(PATTERNS)


def _any(kinds: tuple[str, ...]) -> str:
    return "(?:" + "|".join(f"(?:{_OF[k]})" for k in kinds) + ")"


#: All patterns, behind one test that no word goes on and one look at the first character.
ANY = (rf"(?<!{_W})(?:(?=[0-9+(]){_any(('ip', 'ssn', 'phone', 'card', 'secret'))}|(?=[A-Z]){_any(('iban', 'secret'))}|(?=\p{{Lu}}){_any(('name',))}"
       rf"|(?=[a-gs]){_any(('secret',))}|{_any(('email',))})")
#: A text that has none of these has no entity; a cheap test for the many texts without one.
HINT = r"[0-9@]"
HINT_NAME = rf"(?=\p{{Lu}})(?<!{_W})(?:(?:{_TITLE})\.?|{_GIVEN}) \p{{Lu}}"
_DIGIT_KINDS = ("ssn", "phone", "card")
#: Attempts before an entity is given up, which ends the job. The share of refusals falls with every one.
ATTEMPTS = 24
#: Canonical forms that one task makes surrogates for, about.
FORMS_A_TASK = 2_000


def entities(text: Column) -> Column:
    """Entities of a text in order; an empty list if it has none."""
    found = F.regexp_extract_all(text, F.lit(ANY), F.lit(0))
    return F.when(text.rlike(HINT) | text.rlike(HINT_NAME), found).otherwise(F.array().cast("array<string>"))


def kind_of(entity: Column) -> Column:
    kind = F.lit(None).cast("string")
    for name, pattern in reversed(PATTERNS):
        kind = F.when(entity.rlike(f"^(?:{pattern})$"), name).otherwise(kind)
    return kind


def canonical(kind: Column, entity: Column) -> Column:
    """One form for all spellings of an entity."""
    digits = F.regexp_replace(entity, r"\D", "")
    name = F.lower(F.regexp_replace(entity, rf"^(?:{_TITLE})\.? ", ""))
    return (
        F.when(kind.isin(*_DIGIT_KINDS), digits).when(kind == "name", name).when(kind == "iban", F.upper(F.replace(entity, F.lit(" "), F.lit(""))))
        .when(kind == "secret", entity).otherwise(F.lower(entity))
    )


def gender_of(entity: Column) -> Column:
    """f, m or n by the title or else the given name."""
    def first(words: tuple[str, ...]) -> Column:
        return entity.rlike(rf"^(?:{'|'.join(words)})\.? ")

    female, male = (first((*given_names.of(g), *own)) for g, own in (("f", FEMALE), ("m", MALE)))
    return F.when(first(FEMALE_TITLES) | female, "f").when(first(MALE_TITLES) | male, "m").otherwise("n")


def _byte(digest: Column, i: Column) -> Column:
    """Number 0 to 65535 at place i of a hex digest."""
    return F.conv(F.substring(digest, F.pmod(i, F.lit(60)).cast("int") * 2 + 1, F.lit(4)), 16, 10).cast("int")


def _same_class(ch: Column, n: Column) -> Column:
    """A character of the same class and script as ch, chosen by n; other characters stay."""
    def pick(first: str, size: int) -> Column:
        return F.char(F.lit(ord(first)) + F.pmod(n, F.lit(size))) if ord(first) < 128 else F.substring(
            F.lit("".join(chr(ord(first) + i) for i in range(size))), F.pmod(n, F.lit(size)) + 1, F.lit(1))

    return (
        F.when(ch.rlike(r"^\d$"), pick("0", 10)).when(ch.rlike(r"^\p{IsGreek}$"), F.when(ch.rlike(r"^\p{Lu}$"), pick("Α", 17)).otherwise(pick("α", 17)))
        .when(ch.rlike(r"^\p{IsCyrillic}$"), F.when(ch.rlike(r"^\p{Lu}$"), pick("А", 32)).otherwise(pick("а", 32)))
        .when(ch.rlike(r"^\p{Lu}$"), pick("A", 26)).when(ch.rlike(r"^\p{L}$"), pick("a", 26)).otherwise(ch)
    )


def _hex_class(ch: Column, n: Column) -> Column:
    return F.when(ch.rlike("^[a-f]$"), F.char(F.lit(97) + F.pmod(n, F.lit(6)))).when(ch.rlike("^[A-F]$"), F.char(F.lit(65) + F.pmod(n, F.lit(6)))).otherwise(_same_class(ch, n))


def _luhn(digits: Column) -> Column:
    """Sum of the check-digit rule, modulo 10: 0 for a valid number."""
    n = F.length(digits)
    each = F.transform(F.split(digits, ""), lambda d, i: F.when((n - i) % 2 == 0, F.when(d.cast("int") > 4, d.cast("int") * 2 - 9).otherwise(d.cast("int") * 2)).otherwise(d.cast("int")))
    return F.aggregate(each, F.lit(0), lambda a, d: a + d) % 10


def _iban_rest(iban: Column) -> Column:
    """The number of an IBAN (first four characters moved to the end, letters as 10 to 35), modulo 97: 1 for a valid one."""
    moved = F.split(F.concat(F.substring(iban, F.lit(5), F.length(iban)), F.substring(iban, 1, 4)), "")
    step = lambda a, c: F.when(c.rlike(r"^\d$"), a * 10 + c.cast("int")).otherwise(a * 100 + F.ascii(c) - 55) % 97
    return F.aggregate(moved, F.lit(0), step)


def surrogate(kind: Column, canon: Column, gender: Column, key: str, attempt: int, family: Column | None = None) -> Column:
    """Candidate for the canonical form of an entity. family: the surrogate of a full name's last word, where it has one."""
    digest = F.sha2(F.concat_ws("\u0001", F.lit(key), kind, canon, F.lit(str(attempt))), 512)
    chars = F.split(canon, "")
    by_class = F.array_join(F.transform(chars, lambda c, i: _same_class(c, _byte(digest, i))), "")
    as_hex = F.array_join(F.transform(chars, lambda c, i: _hex_class(c, _byte(digest, i))), "")
    octets = F.array_join(F.transform(F.split(canon, r"\."), lambda c, i: (F.pmod(_byte(digest, i), F.lit(223)) + 1).cast("string")), ".")
    domain = F.split(F.substring_index(canon, "@", -1), r"\.")
    size = F.size(domain)
    # The replaced label grows by two letters with every attempt, and the pool of addresses 676 times.
    grown = F.array_join(F.transform(F.sequence(F.lit(1), F.lit(2 * attempt)), lambda i: F.char(F.lit(97) + F.pmod(_byte(digest, i + 45), F.lit(26)))), "") if attempt else F.lit("")
    labels = F.transform(domain, lambda c, i: F.when(i == size - 1, c).when(i == size - 2, F.concat(F.lit("example"), grown)).otherwise(
        F.array_join(F.transform(F.split(c, ""), lambda ch, j: _same_class(ch, _byte(digest, j + 31))), "")))
    mail = F.concat(F.array_join(F.transform(F.split(F.substring_index(canon, "@", 1), ""), lambda c, i: _same_class(c, _byte(digest, i))), ""), F.lit("@"), F.array_join(labels, "."))
    # The last digit of a number is set so that the check of the original holds or fails again.
    body = F.substring(by_class, F.lit(1), F.length(by_class) - 1)
    right = F.pmod(F.lit(10) - _luhn(F.concat(body, F.lit("0"))), F.lit(10))
    wrong = F.pmod(right + 1 + F.pmod(_byte(digest, F.lit(59)), F.lit(9)), F.lit(10))
    card = F.concat(body, F.when(_luhn(canon) == 0, right).otherwise(wrong).cast("string"))
    # The two check digits of an IBAN are set so that it is valid if the original was, and else are one more than that.
    account = F.substring(by_class, F.lit(5), F.length(canon))
    valid = F.lit(98) - _iban_rest(F.concat(F.substring(canon, 1, 2), F.lit("00"), account))
    check = F.when(_iban_rest(canon) == 1, valid).otherwise(F.when(valid == 98, 2).otherwise(valid + 1))
    iban = F.concat(F.substring(canon, 1, 2), F.lpad(check.cast("string"), 2, "0"), account)
    secret = F.when(canon.rlike("^[0-9A-Fa-f]+$"), as_hex).otherwise(
        F.concat(F.regexp_extract(canon, "^(AKIA|gh[pousr]_|sk-)?", 0), F.substring(by_class, F.length(F.regexp_extract(canon, "^(AKIA|gh[pousr]_|sk-)?", 0)) + 1, F.length(canon))))

    def part(words: tuple[str, ...], at: int) -> Column:
        return F.get(F.array(*map(F.lit, words)), F.pmod(_byte(digest, F.lit(at)), F.lit(len(words))))

    def person(female: tuple, male: tuple, starts: tuple, ends: tuple) -> Column:
        def first(at: int) -> Column:
            return F.when(gender == "f", part(female, at)).when(gender == "m", part(male, at)).otherwise(part((*female, *male), at))

        given = F.concat_ws("-", *[first(1 + 2 * i) for i in range(1 + attempt // 3)])  # more given names, more people of one family
        middle = [F.lower(part(starts, 9 + 2 * i)) for i in range(1 + attempt // 4)]  # more syllables, more names
        surname = F.concat(part(starts, 5), *middle, part(ends, 7))
        return surname if family is None else F.concat(given, F.lit(" "), family)

    name = person(FEMALE, MALE, SURNAME_STARTS, SURNAME_ENDS)
    for script, parts in OTHER_SCRIPTS.items():
        name = F.when(canon.rlike(rf"^\p{{Is{script}}}"), person(*parts)).otherwise(name)
    return (
        F.when(kind == "email", mail).when(kind == "ip", octets).when(kind == "card", card).when(kind == "iban", iban)
        .when(kind == "secret", secret).when(kind == "name", F.lower(name)).otherwise(by_class)
    )


def spelled(kind: Column, entity: Column, canon: Column, sur: Column) -> Column:
    """The surrogate in the format of one spelling of its entity."""
    chars = F.split(entity, "")
    digits = F.array_join(F.transform(chars, lambda c, i: F.when(c.rlike(r"^\d$"), F.substring(
        sur, F.length(F.regexp_replace(F.substring(entity, F.lit(1), i + 1), r"\D", "")), F.lit(1))).otherwise(c)), "")
    spaced = F.array_join(F.transform(chars, lambda c, i: F.when(c == " ", c).otherwise(F.substring(
        sur, F.length(F.replace(F.substring(entity, F.lit(1), i + 1), F.lit(" "), F.lit(""))), F.lit(1)))), "")
    title = F.regexp_extract(entity, rf"^(?:{_TITLE})\.? ", 0)
    local = F.substring_index(entity, "@", 1)
    mail = F.concat(
        F.array_join(F.transform(F.split(local, ""), lambda c, i: F.when(c.rlike(r"^\p{Lu}$"), F.upper(F.substring(sur, i + 1, F.lit(1)))).otherwise(F.substring(sur, i + 1, F.lit(1)))), ""),
        F.substring(sur, F.length(local) + 1, F.length(sur)))
    return (
        F.when(kind.isin(*_DIGIT_KINDS), digits).when(kind == "iban", spaced).when(kind == "name", F.concat(title, F.replace(F.initcap(F.replace(sur, F.lit("-"), F.lit("- "))), F.lit("- "), F.lit("-"))))
        .when(kind == "email", mail).otherwise(sur)
    )


def surrogates(spellings: DataFrame, key: str) -> DataFrame:
    """kind, canon and surrogate of every canonical form: surrogates are distinct, and none is an entity of the corpus.

    The last words of full names are forms, too. They get their surrogates first, and full names are built from them.
    """
    full = (F.col("kind") == "name") & F.col("canon").contains(" ")
    last = F.substring_index("canon", " ", -1)
    families = spellings.filter(full).select("kind", last.alias("canon"), F.lit("n").alias("gender"))
    forms = spellings.select("kind", "canon", "gender").unionByName(families).groupBy("kind", "canon").agg(F.min("gender").alias("gender"))
    forms = materialise(forms, "pii-forms")
    forms = materialise(forms.repartition(-(-forms.count() // FORMS_A_TASK) or 1, "kind", "canon"), "pii-forms")
    real = forms.select("kind", F.col("canon").alias("sur"))
    alone = _distinct(forms.filter(~full).withColumn("family", F.lit(None).cast("string")), real, key)
    known = alone.filter("kind = 'name'").select(F.col("canon").alias("_last"), F.col("sur").alias("family"))
    whole = forms.filter(full).withColumn("_last", last).join(known, "_last").select("kind", "canon", "gender", "family")
    return alone.unionByName(_distinct(whole, real, key, families=True))


def _distinct(forms: DataFrame, real: DataFrame, key: str, families: bool = False) -> DataFrame:
    """Surrogates of some forms in rounds: refused are those that are in `real` or that another form has."""
    left = forms = materialise(forms, "pii-left")
    taken = None
    for attempt in range(ATTEMPTS):
        sur = surrogate(F.col("kind"), F.col("canon"), F.col("gender"), key, attempt, F.col("family") if families else None)
        tried = left.withColumn("sur", sur).join(real, ["kind", "sur"], "left_anti")
        if taken is not None:
            tried = tried.join(taken.select("kind", "sur"), ["kind", "sur"], "left_anti")
        one = tried.groupBy("kind", "sur").agg(F.min("canon").alias("canon"))
        won = materialise(one.select("kind", "canon", "sur"), "pii-surrogates")
        taken = won if taken is None else taken.unionByName(won)
        left = forms.join(taken, ["kind", "canon"], "left_anti")
        if left.isEmpty():
            return taken
    raise ValueError("entities are left without a surrogate; their formats have too few values")


def pseudonymise(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """The rows with every entity in `text` replaced; `entities` counts them, `kinds` lists their kinds."""
    names = [c for c in docs.columns if c not in ("entities", "kinds")]
    plain = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)])
    done = _pseudonymise(plain, key, f"c{names.index(text)}")
    return done.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)], "entities", "kinds")


def _pseudonymise(docs: DataFrame, key: str, text: str) -> DataFrame:
    rows = docs.withColumn("_found", F.coalesce(entities(F.col(text).cast("string")), F.array().cast("array<string>")))
    rows = materialise(rows, "pii-rows")  # texts are searched once
    # Entities of each text that has some; equal texts are one row.
    per_text = rows.filter(F.size("_found") > 0).select(F.md5(F.col(text)).alias("_md5"), F.array_distinct("_found").alias("found")).dropDuplicates(["_md5"])
    per_text = materialise(per_text, "pii-found")
    spellings = per_text.select(F.explode("found").alias("entity")).distinct().withColumn("kind", kind_of(F.col("entity")))
    spellings = spellings.select("entity", "kind", canonical(F.col("kind"), F.col("entity")).alias("canon"), gender_of(F.col("entity")).alias("gender"))
    spellings = materialise(spellings, "pii-spellings")
    sur = surrogates(spellings, key)
    spoken = spellings.join(sur, ["kind", "canon"]).select("entity", "kind", spelled(F.col("kind"), F.col("entity"), F.col("canon"), F.col("sur")).alias("instead"))
    maps = per_text.select("_md5", F.explode("found").alias("entity")).join(spoken, "entity").groupBy("_md5").agg(
        F.map_from_entries(F.collect_list(F.struct("entity", F.struct("instead", "kind")))).alias("_map"))
    maps = materialise(maps, "pii-maps")
    return _replaced(rows, maps, text)


def _replaced(rows: DataFrame, maps: DataFrame, text: str) -> DataFrame:
    # The rows without an entity stay where they are; only the others meet their replacements.
    columns = [c for c in rows.columns if c != "_found"]
    none = F.array().cast("array<string>")
    same = rows.filter(F.size("_found") == 0).select(*columns, F.lit(0).alias("entities"), none.alias("kinds"))
    met = rows.filter(F.size("_found") > 0).withColumn("_md5", F.md5(F.col(text))).join(maps, "_md5")
    met = met.withColumn("_between", F.split(F.col(text), ANY, -1))
    pieces = F.zip_with("_between", "_found", lambda b, e: F.concat(b, F.coalesce(F.try_element_at(F.col("_map"), e)["instead"], F.lit(""))))
    kinds = F.array_sort(F.array_distinct(F.transform(F.map_values("_map"), lambda v: v["kind"])))
    changed = met.select(*[c for c in columns if c != text], F.array_join(pieces, "").alias(text), F.size("_found").alias("entities"), kinds.alias("kinds"))
    return same.unionByName(changed)
