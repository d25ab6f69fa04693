"""Surrogates for personal data: keyed, type-consistent, distinct and coreferent.

Entities are found by pattern. What stands for an entity follows from a secret key, its
kind and its canonical form, so one person's address is replaced alike in all texts and
spellings. A surrogate keeps what the form tells: letters stay letters of their case,
digits digits, separators stay; cards keep their issuer and check digit, names their
gender and script. A surname is an entity, and so is a given name with its surname and
gender, so that two full names never show one surrogate. Different entities that would get one surrogate, or a surrogate that is
itself an entity of the corpus, are drawn again until none is left. Each draw has more to
choose from than the one before: letters, syllables or, where the form is fixed and draws
within it have failed, digits behind a hyphen are added. All of it is built from Spark's own
functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.llm.common import fresh, has_rows, text_digest
from millrace.session import stored_rows

# Titles that tell a name and its bearer's gender, and given names by gender.
MALE_TITLES = "Mr|Herr|Monsieur|Señor|Signor|г-н"
FEMALE_TITLES = "Mrs|Ms|Miss|Frau|Madame|Mme|Señora|Signora|г-жа"
GIVEN = {
    ("m", "latin"): "Adam Bruno Carl David Emil Felix Georg Hugo Ivan Jonas Karl Leon Martin Nils Oscar Paul".split(),
    ("f", "latin"): "Anna Berta Clara Diana Emma Flora Greta Helen Irene Julia Karla Laura Maria Nora Olga Paula".split(),
    ("m", "cyrillic"): "Антон Борис Виктор Глеб Денис Егор Захар Иван Кирилл Лев Марк Назар Олег Павел Роман Юрий".split(),
    ("f", "cyrillic"): "Анна Вера Галина Дарья Елена Жанна Зоя Инна Кира Лидия Мария Нина Ольга Полина Раиса Юлия".split(),
}

_NAME = r"\p{Lu}(?:\.|[\p{L}'-]+)"
PATTERNS = {
    "email": r"[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63})+",
    "ip": r"(?<![\w.])(?:\d{1,3}\.){3}\d{1,3}(?!\w|\.\d)",
    "card": r"(?<!\w)\d{4}[ -]?\d{4}[ -]?\d{4}[ -]?\d{3,4}(?!\w)",
    "ssn": r"(?<!\w)\d{3}-\d{2}-\d{4}(?!\w)",
    "phone": r"(?:\+\d{1,3}[ .-]?)?\(?\d{3}\)?[ .-]?\d{3}[ .-]\d{4}(?!\w)",
    "abroad": r"(?<!\w)\+\d{1,3}(?:[ .-]?\(?\d{2,4}\)?){2,4}(?!\w)",
    "iban": r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?!\w)",
    "key": r"(?<!\w)AKIA[A-Z0-9]{16}(?!\w)",
    "secret": r"(?i:(?<![^\W_])(?:password|passwd|pwd|token|secret|api[_-]?key)[\"']?\s{0,2}[=:]\s{0,2}[\"']?)[A-Za-z0-9+/_-]{6,}",
    "name": rf"(?<!\w)(?:{MALE_TITLES}|{FEMALE_TITLES})\.? {_NAME}(?: {_NAME})?",
}
# No entity begins inside a word: most places of a text are passed over at once. The keyword
# of a secret may follow an underscore.
PATTERN = (
    r"(?<![^\W_])(?:"
    + "|".join(f"(?:{p})" if kind == "secret" else rf"(?<!\w)(?:{p})" for kind, p in PATTERNS.items())
    + ")"
)
#: Texts without a digit, an at sign or one of these words, the first in any case, have no entity.
KEYWORDS = ("password", "passwd", "pwd", "token", "secret", "apikey", "api_key", "api-key")
TITLES = f"{MALE_TITLES}|{FEMALE_TITLES}".split("|")


def _may_hold(text: Column) -> Column:
    """Cheap and never wrongly false."""
    hit = F.regexp_like(text, F.lit("[0-9@]"))
    for word in TITLES:
        hit = hit | F.contains(text, F.lit(word))
    for word in KEYWORDS:
        hit = hit | F.contains(F.lower(text), F.lit(word))
    return hit


def kind_of(entity: Column) -> Column:
    picked = F.when(entity.contains("@"), F.lit("email"))
    for kind in ("key", "name", "secret", "ip", "card", "ssn", "phone", "iban"):
        picked = picked.when(F.regexp_like(entity, F.lit(f"^(?:{PATTERNS[kind]})$")), F.lit(kind))
    return picked.otherwise(F.lit("abroad"))


def _alnum(text: Column) -> Column:
    return F.regexp_replace(text, r"[^\p{L}\p{N}]", "")


_BEFORE_VALUE = r"[\w-]+[\"']?\s*[=:]\s*[\"']?"


def _value(secret: Column) -> Column:
    return F.regexp_replace(secret, f"^{_BEFORE_VALUE}", "")


def canonical(kind: Column, entity: Column) -> Column:
    """The form that spellings of one entity share."""
    return (
        F.when(kind == "email", F.lower(entity))
        .when(kind == "phone", F.right(_alnum(entity), F.lit(10)))
        .when(kind == "secret", _value(entity))
        .when(kind == "name", F.regexp_extract(entity, r"(\S+)$", 1))
        .when(kind.isin("ip", "key"), entity)
        .otherwise(_alnum(entity))
    )


_TITLE = rf"^(?:{MALE_TITLES}|{FEMALE_TITLES})\.? "


def given_canonical(entity: Column) -> Column:
    """Of a name: gender, surname and given name; null where no given name is."""
    given = F.regexp_extract(entity, rf"{_TITLE}(\S+) ", 1)
    gender = F.when(F.regexp_like(entity, F.lit(rf"^(?:{MALE_TITLES})\b")), F.lit("m")).otherwise(F.lit("f"))
    return F.when(
        given != "", F.concat(gender, F.lit("|"), F.regexp_extract(entity, r"(\S+)$", 1), F.lit("|"), given)
    )


def _stream(*parts: Column) -> Column:
    """128 hexadecimal digits from the parts."""
    joined = F.concat_ws("|", *parts)
    return F.concat(F.sha2(joined, 256), F.sha2(F.concat(joined, F.lit("|more")), 256))


LETTERS = 86  # base64 characters of 64 bytes


def _letters(hexes: Column) -> Column:
    """``LETTERS`` letters, each of the whole alphabet."""
    return F.translate(F.lower(F.base64(F.unhex(hexes))), "0123456789+/=\r\n", "abcdefghijkl")


def _digits(hexes: Column) -> Column:
    return F.translate(hexes, "abcdef", "274958")


def _fill(surface: Column, hexes: Column, keep: Column | int = 0) -> Column:
    """The surface with its letters and digits drawn anew from ``hexes``, but for the first ``keep``."""
    keep = keep if isinstance(keep, Column) else F.lit(keep)
    start = F.struct(
        F.lit("").alias("out"), F.lit(0).alias("n"), _letters(hexes).alias("letters"), _digits(hexes).alias("digits")
    )

    def step(at: Column, c: Column) -> Column:
        digit, letter = F.regexp_like(c, F.lit("^[0-9]$")), F.regexp_like(c, F.lit("^\\p{L}$"))
        drawn_letter = F.substring(at["letters"], F.pmod(at["n"] - keep, F.lit(LETTERS)) + 1, F.lit(1))
        drawn = (
            F.when(at["n"] < keep, c)
            .when(digit, F.substring(at["digits"], F.pmod(at["n"] - keep, F.lit(128)) + 1, F.lit(1)))
            .when(F.upper(c) == c, F.upper(drawn_letter))
            .otherwise(drawn_letter)
        )
        return F.struct(
            F.concat(at["out"], F.when(digit | letter, drawn).otherwise(c)).alias("out"),
            (at["n"] + (digit | letter).cast("int")).alias("n"),
            at["letters"].alias("letters"),
            at["digits"].alias("digits"),
        )

    return F.aggregate(F.split(surface, ""), start, step)["out"]


def _checked(digits: Column) -> Column:
    """The digits with the last one set so that the Luhn sum is right."""
    body = F.substring(digits, F.lit(1), F.length(digits) - 1)
    doubled = F.transform(
        F.split(F.reverse(body), ""),
        lambda d, i: F.when(i % 2 == 0, F.when(d.cast("int") > 4, 2 * d.cast("int") - 9).otherwise(2 * d.cast("int")))
        .otherwise(d.cast("int")),
    )
    total = F.aggregate(doubled, F.lit(0), lambda a, b: a + b)
    return F.concat(body, F.pmod(-total, F.lit(10)).cast("string"))


def _into(surface: Column, drawn: Column) -> Column:
    """``drawn`` letters and digits in the format of ``surface``; what it has more in front stays."""
    more = F.length(_alnum(surface)) - F.length(drawn)
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("n"))

    def step(at: Column, c: Column) -> Column:
        counts = F.regexp_like(c, F.lit("^[\\p{L}\\p{N}]$"))
        new = F.when(at["n"] < more, c).otherwise(F.substring(drawn, at["n"] - more + 1, F.lit(1)))
        return F.struct(
            F.concat(at["out"], F.when(counts, new).otherwise(c)).alias("out"), (at["n"] + counts.cast("int")).alias("n")
        )

    return F.aggregate(F.split(surface, ""), start, step)["out"]


def _cyrillic(text: Column) -> Column:
    return F.regexp_like(text, F.lit("\\p{IsCyrillic}"))


def _spoken(hexes: Column, like: Column, attempt: Column) -> Column:
    """A surname of three syllables, and one more each attempt, in the script of ``like``."""
    consonants = F.translate(hexes, "0123456789abcdef", "bdfghklmnprstvzk")
    vowels = F.translate(hexes, "0123456789abcdef", "aeiouaeiouaeioua")
    syllables = F.transform(
        F.sequence(F.lit(0), attempt + 2),
        lambda i: F.concat(F.substring(consonants, 2 * i + 1, F.lit(1)), F.substring(vowels, 2 * i + 2, F.lit(1))),
    )
    latin = F.initcap(F.array_join(syllables, ""))
    return F.when(
        _cyrillic(like), F.translate(latin, "bdfghklmnprstvzaeiouBDFGHKLMNPRSTVZ", "бдфгхклмнпрствзаеиоуБДФГХКЛМНПРСТВЗ")
    ).otherwise(latin)


def _given(canon: Column, hexes: Column, attempt: Column) -> Column:
    """Given names or initials of the gender and script, one more each attempt, with hyphens."""
    given = F.substring_index(canon, "|", -1)
    male, cyrillic, initial = F.startswith(canon, F.lit("m|")), _cyrillic(given), F.endswith(given, F.lit("."))

    def pool(gender: str, script: str) -> Column:
        return F.array(*map(F.lit, GIVEN[gender, script]))

    names = (
        F.when(male & cyrillic, pool("m", "cyrillic"))
        .when(male, pool("m", "latin"))
        .when(cyrillic, pool("f", "cyrillic"))
        .otherwise(pool("f", "latin"))
    )

    def one(i: Column) -> Column:
        name = F.element_at(names, F.instr(F.lit("0123456789abcdef"), F.substring(hexes, i + 1, F.lit(1))))
        return F.when(initial, F.concat(F.substring(name, 1, 1), F.lit("."))).otherwise(name)

    return F.array_join(F.transform(F.sequence(F.lit(0), attempt), one), "-")


def draw(kind: Column, canon: Column, attempt: Column, key: str) -> Column:
    """The hexadecimal digits a surrogate is made of."""
    return _stream(F.lit(key), kind, canon, attempt.cast("string"))


IN_FORM = 5  # draws within a fixed form, before it is given digits more


def surrogate(kind: Column, canon: Column, hexes: Column, key: str, attempt: Column | int = 0) -> Column:
    """What stands for an entity in canonical form, from its drawn digits.

    The arguments are used many times over: pass columns or fields, not expressions. What is
    added to a fixed form stands behind a ``#``.
    """
    attempt = attempt if isinstance(attempt, Column) else F.lit(attempt)
    digits = _digits(hexes)
    more = F.when(attempt > 0, F.substring(F.reverse(_letters(hexes)), F.lit(1), attempt)).otherwise(F.lit(""))
    free = kind.isin("email", "name", "given", "secret")
    octets = [
        F.pmod(F.conv(F.substring(hexes, 2 * i + 1, 2), 16, 10).cast("int"), F.lit(m)) + a
        for i, (m, a) in enumerate(((115, 11), (256, 0), (256, 0), (254, 1)))
    ]
    domain = F.substring_index(canon, "@", -1)
    host = _fill(F.substring_index(domain, ".", 1), _stream(F.lit(key), F.lit("domain"), domain))
    top = F.substring_index(domain, ".", -1)
    area = F.translate(digits, "01", "23")
    made = (
        F.when(
            kind == "email",
            F.concat(
                _fill(F.substring_index(canon, "@", 1), hexes),
                more,
                F.lit("@"),
                host,
                F.lit(".example."),
                F.when(top.isin("com", "net", "org"), top).otherwise(F.lit("org")),
            ),
        )
        .when(kind == "ip", F.concat_ws(".", *[o.cast("string") for o in octets]))
        .when(kind == "card", _checked(_fill(canon, hexes, 1)))
        .when(kind == "ssn", F.concat(F.lit("9"), F.substring(digits, 2, 8)))
        .when(
            kind == "phone",
            F.concat(F.substring(area, 1, 1), F.substring(digits, 2, 2), F.substring(area, 4, 1), F.substring(digits, 5, 6)),
        )
        .when(kind == "abroad", _fill(canon, hexes, 2))
        .when(kind == "iban", _fill(canon, hexes, 2))
        .when(kind == "key", _fill(canon, hexes, 4))
        .when(kind == "name", _spoken(hexes, canon, attempt))
        # Told apart within a gender and surname; a given name may well be one of the corpus.
        .when(
            kind == "given",
            F.concat(F.substring_index(canon, "|", 2), F.lit(">"), _given(canon, hexes, attempt)),
        )
        .when(
            F.regexp_like(canon, F.lit("^[0-9a-f]+$")),
            F.concat(F.substring(hexes, F.lit(1), F.length(canon)), F.substring(F.reverse(hexes), F.lit(1), attempt)),
        )
        .otherwise(F.concat(_fill(canon, hexes), more))
    )
    added = F.substring(F.reverse(digits), F.lit(1), attempt - IN_FORM)
    return F.when(free | (attempt <= IN_FORM), made).otherwise(F.concat(made, F.lit("#"), added))


def _shown(kind: Column, entity: Column, stand_in: Column, given: Column) -> Column:
    """The surrogate in the format of the spelling it replaces; ``given`` is a name's other one."""
    title = F.regexp_extract(entity, f"({_TITLE})", 1)
    named = F.coalesce(F.concat(F.substring_index(given, ">", -1), F.lit(" ")), F.lit(""))
    upper = (F.upper(entity) == entity) & (F.lower(entity) != entity)
    # Digits that were added to a fixed form come last.
    added = F.when(stand_in.contains("#"), F.concat(F.lit("-"), F.substring_index(stand_in, "#", -1))).otherwise(F.lit(""))
    in_form = F.substring_index(stand_in, "#", 1)
    return (
        F.when(kind == "name", F.concat(title, named, stand_in))
        .when(kind == "secret", F.concat(F.regexp_extract(entity, f"^({_BEFORE_VALUE})", 1), stand_in))
        .when((kind == "email") & upper, F.upper(stand_in))
        .when(kind == "email", stand_in)
        .when(kind.isin("ip", "key"), F.concat(in_form, added))
        .otherwise(F.concat(_into(entity, in_form), added))
    )


def found_entities(docs: DataFrame) -> DataFrame:
    """(id, digest, found): the entities of the texts that have any, in their order.

    Rows with equal doc_id and text are one; a null doc_id is an id of its own.
    """
    keyed = docs.select(_id(), text_digest().alias("digest"), "text").where(_may_hold(F.col("text")))
    found = keyed.select("id", "digest", F.regexp_extract_all("text", F.lit(f"({PATTERN})"), 1).alias("found"))
    return found.where(F.size("found") > 0)


def _id() -> Column:
    return F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id")


def entities(found: DataFrame) -> DataFrame:
    """(kind, canon) of all distinct entities found."""
    surface = found.select(F.explode("found").alias("entity")).distinct()
    kinds = surface.withColumn("kind", kind_of(F.col("entity")))
    return _named(kinds).select("kind", "canon").distinct()


def _named(kinds: DataFrame) -> DataFrame:
    """The rows with ``canon``, and once more with kind "given" for names that have one."""
    parts = F.array(
        F.struct(F.col("kind"), canonical(F.col("kind"), F.col("entity")).alias("canon")),
        F.struct(F.lit("given").alias("kind"), F.when(F.col("kind") == "name", given_canonical(F.col("entity"))).alias("canon")),
    )
    others = [c for c in kinds.columns if c != "kind"]
    return kinds.select(*others, F.explode(parts).alias("part")).select(*others, "part.*").where("canon IS NOT NULL")


def drawn_again(known: DataFrame, key: str) -> DataFrame:
    """(kind, canon, attempt) of the entities whose first surrogates won't do.

    In each round, of the entities of a kind with one surrogate the least keeps it, unless
    the surrogate is an entity itself; the others are drawn again, from more surrogates than
    before, so that the rounds end however many entities there are.
    """
    now = stored_rows(known.withColumn("attempt", F.lit(0)))
    while True:
        made = now.withColumn("hexes", draw(F.col("kind"), F.col("canon"), F.col("attempt"), key))
        made = made.withColumn("made", surrogate(F.col("kind"), F.col("canon"), F.col("hexes"), key, F.col("attempt")))
        first = made.groupBy("kind", "made").agg(F.min("canon").alias("first"), F.count(F.lit(1)).alias("n"))
        real = known.select(F.col("kind").alias("k"), F.col("canon").alias("c"))
        wrong = (
            first.join(real, (F.col("kind") == F.col("k")) & (F.col("made") == F.col("c")), "left")
            .where((F.col("n") > 1) | F.col("c").isNotNull())
            .select("kind", "made", "first", F.col("c").isNotNull().alias("taken"))
        )
        wrong = stored_rows(wrong)
        if not has_rows(wrong):
            return now.where("attempt > 0")
        again = F.col("first").isNotNull() & (F.col("taken") | (F.col("canon") != F.col("first")))
        now = stored_rows(
            made.join(wrong, ["kind", "made"], "left").select(
                "kind", "canon", (F.col("attempt") + F.coalesce(again, F.lit(False)).cast("int")).alias("attempt")
            )
        )


def replace_entities(docs: DataFrame, key: str) -> DataFrame:
    """``docs`` with every detected entity replaced, in the same columns and rows, and the
    number of replaced entities as one more column, ``n_replaced``.

    Needs doc_id and text. Null and empty texts stay as they are, texts without entities
    too. Null ids and repeated rows stay; an empty table gives no rows.
    """
    if not key:
        raise ValueError("a secret key is needed")
    found = stored_rows(found_entities(docs).dropDuplicates(["id", "digest"]))
    again = drawn_again(entities(found), key)
    # Which places of which texts hold an entity that was drawn again: few, as a rule none.
    places = _named(
        found.select("id", "digest", F.posexplode("found").alias("at", "entity")).withColumn(
            "kind", kind_of(F.col("entity"))
        )
    )
    # Given names are under -1 - at.
    place = F.when(F.col("kind") == "given", -1 - F.col("at")).otherwise(F.col("at")).alias("at")
    redrawn = stored_rows(
        places.join(again, ["kind", "canon"])
        .groupBy("id", "digest")
        .agg(F.map_from_entries(F.collect_set(F.struct(place, "attempt"))).alias("tries"))
    )
    # A surrogate follows from the key, the entity and the attempt, so each text is rewritten where
    # it stands; only the few redrawn places are looked up, and no text is joined with its own entities.
    names = ("own_id", "own_digest", "tries", "found", "kinds", "canons", "drawn", "made", "put", "between", "n_replaced")
    own_i, own_t, tries, found_, kinds_, canons_, drawn_, made_, put_, between, count = fresh(docs, *names)
    redrawn = redrawn.select(F.col("id").alias(own_i), F.col("digest").alias(own_t), F.col("tries").alias(tries))
    marked = docs.withColumns({own_i: _id(), own_t: text_digest()}).join(redrawn, [own_i, own_t], "left")
    marked = marked.withColumn(
        found_, F.when(_may_hold(F.col("text")), F.regexp_extract_all("text", F.lit(f"({PATTERN})"), 1))
    )
    # One step of the work on each place at a time, so that no expression is repeated.
    kinds = F.transform(found_, lambda e: F.struct(e.alias("entity"), kind_of(e).alias("kind")))
    canons = F.transform(
        kinds_,
        lambda e, k: F.struct(
            e["entity"].alias("entity"),
            e["kind"].alias("kind"),
            canonical(e["kind"], e["entity"]).alias("canon"),
            F.coalesce(F.element_at(tries, k), F.lit(0)).alias("attempt"),
            F.when(e["kind"] == "name", given_canonical(e["entity"])).alias("given"),
            F.coalesce(F.element_at(tries, -1 - k), F.lit(0)).alias("given_attempt"),
        ),
    )
    drawn = F.transform(
        canons_,
        lambda e: F.struct(
            e["entity"].alias("entity"),
            e["kind"].alias("kind"),
            e["canon"].alias("canon"),
            e["attempt"].alias("attempt"),
            draw(e["kind"], e["canon"], e["attempt"], key).alias("hexes"),
            e["given"].alias("given"),
            e["given_attempt"].alias("given_attempt"),
            F.when(
                e["given"].isNotNull(), draw(F.lit("given"), e["given"], e["given_attempt"], key)
            ).alias("given_hexes"),
        ),
    )
    made = F.transform(
        drawn_,
        lambda e: F.struct(
            e["entity"].alias("entity"),
            e["kind"].alias("kind"),
            surrogate(e["kind"], e["canon"], e["hexes"], key, e["attempt"]).alias("made"),
            F.when(e["given"].isNotNull(), _given(e["given"], e["given_hexes"], e["given_attempt"])).alias("given"),
        ),
    )
    put = F.transform(made_, lambda e: _shown(e["kind"], e["entity"], e["made"], e["given"]))
    steps = ((kinds_, kinds), (canons_, canons), (drawn_, drawn), (made_, made), (put_, put))
    for name, step in steps:
        marked = marked.withColumn(name, step)
    some = F.size(put_) > 0
    marked = marked.withColumn(between, F.when(some, F.split("text", PATTERN)))
    pieces = F.zip_with(F.slice(between, F.lit(1), F.size(put_)), F.col(put_), lambda a, b: F.concat(a, b))
    rewritten = F.concat(F.array_join(pieces, ""), F.element_at(between, -1))
    out = marked.withColumn(count, F.when(some, F.size(put_)).otherwise(F.lit(0)))
    out = out.withColumn("text", F.when(some, rewritten).otherwise(F.col("text")))
    return out.select(*docs.columns, count)
