"""Deterministic replacement of personal data with a persistent mapping table."""

from __future__ import annotations

import warnings
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.functions.hashing import one_way_hash, pii_normal_form
from millrace.operators.mapping import quoted
from millrace.session import stored_rows

MAPPING_SCHEMA = (
    "source_system string, field_name string, context string, hash_algorithm string, "
    "hash_value string, replacement_value string, created_at timestamp, updated_at timestamp"
)
MAPPING_KEY = ["source_system", "field_name", "context", "hash_algorithm", "hash_value"]

# Accepted field types and the generator each one uses.
FIELD_TYPES = {
    "name": "name",
    "person": "name",
    "address": "address",
    "street": "street_address",
    "city": "city",
    "postal_code": "postcode",
    "postcode": "postcode",
    "email": "email",
    "phone": "phone_number",
    "phone_number": "phone_number",
    "company": "company",
    "organization": "company",
    "text": "sentence",
    "sentence": "sentence",
}


@dataclass(frozen=True)
class WordPools:
    """Words the realistic replacements are put together from."""

    first: tuple[str, ...]
    last: tuple[str, ...]
    street: tuple[str, ...]
    city_start: tuple[str, ...]
    city_end: tuple[str, ...]
    company_kind: tuple[str, ...]
    adjective: tuple[str, ...]
    noun: tuple[str, ...]
    verb: tuple[str, ...]
    domain: tuple[str, ...] = ("example.com", "example.net", "example.org")


POOLS = {
    "en_US": WordPools(
        first=("Ada", "Ben", "Cora", "Dan", "Elsie", "Finn", "Grace", "Hugh", "Iris", "Jack",
               "Kate", "Liam", "Mona", "Noel", "Olive", "Paul", "Quinn", "Rose", "Seth", "Tess"),
        last=("Archer", "Baker", "Carver", "Dyer", "Ellis", "Fisher", "Glover", "Hunter", "Irwin",
              "Joyner", "Keeler", "Lister", "Mason", "Naylor", "Osborn", "Porter", "Reeve",
              "Sawyer", "Tanner", "Walker"),
        street=("Oak Street", "Mill Lane", "Hill Road", "Park Avenue", "Lake Drive",
                "Church Street", "Garden Way", "Station Road", "River Court", "Market Square"),
        city_start=("North", "South", "East", "West", "New", "Old", "Fair", "Green", "Spring",
                    "Ash"),
        city_end=("field", "ton", "ville", "burg", "port", "wood", "mouth", "ford", "dale",
                  "haven"),
        company_kind=("Group", "Partners", "Supply", "Works", "Trading", "Logistics"),
        adjective=("quiet", "bright", "early", "narrow", "steady", "plain", "warm", "distant"),
        noun=("river", "market", "garden", "engine", "window", "harbour", "letter", "bridge"),
        verb=("crosses", "follows", "reaches", "covers", "serves", "meets"),
    ),
    "de_DE": WordPools(
        first=("Anna", "Bernd", "Clara", "Dirk", "Elke", "Felix", "Greta", "Hans", "Ida", "Jonas",
               "Katja", "Lars", "Mia", "Nils", "Olga", "Peter", "Rita", "Sven", "Tina", "Uwe"),
        last=("Bauer", "Becker", "Fischer", "Gruber", "Huber", "Jäger", "Keller", "Lang",
              "Maurer", "Neumann", "Otto", "Pohl", "Richter", "Schmied", "Töpfer", "Vogt",
              "Weber", "Zimmer", "Wolf", "Kraus"),
        street=("Hauptstraße", "Gartenweg", "Bahnhofstraße", "Lindenallee", "Mühlgasse",
                "Bergstraße", "Kirchplatz", "Schulweg", "Seestraße", "Marktplatz"),
        city_start=("Neu", "Alt", "Grün", "Ober", "Unter", "Nord", "Süd", "Stein", "Wald", "Berg"),
        city_end=("stadt", "dorf", "heim", "burg", "feld", "bach", "hausen", "brück", "kirchen",
                  "au"),
        company_kind=("GmbH", "AG", "KG", "OHG", "Handel", "Logistik"),
        adjective=("stille", "helle", "frühe", "schmale", "feste", "warme", "ferne", "neue"),
        noun=("Brücke", "Straße", "Maschine", "Lampe", "Mühle", "Halle", "Karte", "Wiese"),
        verb=("kreuzt", "erreicht", "deckt", "trifft", "folgt", "hält"),
    ),
}

# How a second holder of one generated text is told apart: separator and the part
# of the text that stays behind the number.
_SUFFIX = {"email": (".", "@.*"), "sentence": (" ", r"\."), "postcode": ("-", ""),
           "phone_number": (" x", "")}


def empty_mapping(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], MAPPING_SCHEMA)


def switched_on(setting: str | None) -> bool:
    """The global switch as text: on unless it says false, 0 or no."""
    return (setting or "").strip().lower() not in {"false", "0", "no"}


def normal_context(context: str | None) -> str:
    return (context or "").strip()


def _number(hash_value: Column, slot: int, size: int) -> Column:
    """A number below ``size`` from five hex digits of the hash."""
    digits = F.substring(hash_value, 1 + 5 * slot, 5)
    return F.conv(digits, 16, 10).cast("int") % size


def _pick(words: Sequence[str], hash_value: Column, slot: int) -> Column:
    return F.element_at(
        F.array(*[F.lit(w) for w in words]), _number(hash_value, slot, len(words)) + 1
    )


def _padded(hash_value: Column, slot: int, width: int) -> Column:
    return F.lpad(_number(hash_value, slot, 10**width).cast("string"), width, "0")


def realistic_text(hash_value: Column, field_type: str, locale: str | None = None) -> Column:
    """A plausible text of the given kind, decided by the hash alone."""
    kind = FIELD_TYPES.get((field_type or "").strip().lower())
    if kind is None:
        raise ValueError(f"unsupported field_type {field_type!r}; one of {sorted(FIELD_TYPES)}")
    pools = POOLS.get(locale or "en_US")
    if pools is None:
        raise ValueError(f"no word pools for locale {locale!r}; one of {sorted(POOLS)}")
    h = hash_value
    initials = [chr(ord("A") + i) for i in range(26)]
    house = (_number(h, 3, 9999) + 1).cast("string")
    city = F.concat(_pick(pools.city_start, h, 4), _pick(pools.city_end, h, 5))
    space = F.lit(" ")
    if kind == "name":
        middle = F.concat(_pick(initials, h, 2), F.lit("."))
        return F.concat_ws(" ", _pick(pools.first, h, 0), middle, _pick(pools.last, h, 1))
    if kind == "street_address":
        return F.concat(house, space, _pick(pools.street, h, 2))
    if kind == "address":
        return F.concat(
            house, space, _pick(pools.street, h, 2), F.lit(", "), _padded(h, 1, 5), space, city
        )
    if kind == "city":
        return city
    if kind == "postcode":
        return _padded(h, 1, 5)
    if kind == "email":
        local = F.concat_ws(".", _pick(pools.first, h, 0), _pick(pools.last, h, 1))
        plain = F.translate(F.lower(local), "äöüß", "aous")
        return F.concat(plain, _padded(h, 3, 4), F.lit("@"), _pick(pools.domain, h, 2))
    if kind == "phone_number":
        return F.concat(F.lit("+1-555-"), _padded(h, 0, 3), F.lit("-"), _padded(h, 1, 4))
    if kind == "company":
        return F.concat_ws(
            " ", _pick(pools.last, h, 0), _pick(pools.noun, h, 2), _pick(pools.company_kind, h, 1)
        )
    words = [pools.adjective, pools.noun, pools.verb, pools.adjective, pools.noun]
    picked = [_pick(w, h, i) for i, w in enumerate(words)]
    return F.concat(F.initcap(picked[0]), space, F.concat_ws(" ", *picked[1:]), F.lit("."))


def prefixed_text(
    hash_value: Column, field_name: str, prefix: str | None = None, max_length: int = 64
) -> Column:
    """Prefix and as much of the hash as fits; default prefix from the field name."""
    if max_length <= 0:
        raise ValueError("max_length must be positive")
    head = f"{(field_name or 'PII').upper()[:8]}_" if prefix is None else prefix
    return F.substring(F.concat(F.lit(head), hash_value), 1, max_length)


def _kind_suffix(field_type: str) -> tuple[str, str]:
    return _SUFFIX.get(FIELD_TYPES[field_type.strip().lower()], (" ", ""))


def unique_realistic(
    hashes: DataFrame,
    stored: DataFrame,
    field_type: str,
    max_length: int = 64,
    locale: str | None = None,
) -> DataFrame:
    """``hash_value, replacement_value`` with a different text for every hash.

    Hashes that draw one text are numbered in hash order, continuing after the
    highest number already stored for that text.
    """
    separator, tail = _kind_suffix(field_type)
    number_at_end = rf"{separator.replace('.', chr(92) + '.')}(\d+)(?={tail}$)"
    text = realistic_text(F.col("hash_value"), field_type, locale)
    kept_end = F.regexp_extract(text, f"({tail})$", 1) if tail else F.lit("")
    head = F.substr(text, F.lit(1), F.length(text) - F.length(kept_end))
    drawn = hashes.select("hash_value", head.alias("head"), kept_end.alias("tail")).withColumn(
        "drawn", F.concat("head", "tail")
    )
    value = F.col("replacement_value")
    used = (
        stored.select(
            F.regexp_replace(value, number_at_end, "").alias("drawn"),
            F.coalesce(
                F.regexp_extract(value, number_at_end, 1).try_cast("long"), F.lit(1)
            ).alias("n"),
        )
        .groupBy("drawn")
        .agg(F.max("n").alias("used"))
    )
    # Numbers within a text are dealt per leading hash digits, whose groups are even
    # and follow the hash order; each group starts where the ones before it end.
    grouped = drawn.withColumn("lead", F.substring("hash_value", 1, 2))
    before = Window.partitionBy("drawn").orderBy("lead").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        grouped.groupBy("drawn", "lead")
        .agg(F.count("*").alias("n"))
        .withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
        .join(used, "drawn", "left")
        .select("drawn", "lead", (F.coalesce("used", F.lit(0)) + F.col("before")).alias("start"))
    )
    within = Window.partitionBy("drawn", "lead").orderBy("hash_value")
    numbered = (
        grouped.withColumn("place", F.row_number().over(within))
        .join(starts, ["drawn", "lead"])
        .withColumn("number", F.col("start") + F.col("place"))
        .select("hash_value", "head", "tail", "number")
    )
    return _told_apart(numbered, stored, separator, max_length)


def _told_apart(
    numbered: DataFrame, stored: DataFrame, separator: str, max_length: int
) -> DataFrame:
    """``hash_value, replacement_value``, distinct also where texts are cut to their length.

    The number keeps its place and the text before it gives way. Texts that meet once cut,
    or meet a stored one, are numbered anew, all but the first: behind a beginning that
    leaves room for any number, after the highest number in use there. A length that
    cannot hold the numbers is an error.
    """
    taken = stored.select("replacement_value").distinct()
    suffix = F.when(F.col("number") > 1, F.concat(F.lit(separator), F.col("number"))).otherwise("")
    room = F.lit(max_length) - F.length(suffix) - F.length("tail")
    fitted = F.concat(F.substr("head", F.lit(1), F.greatest(room, F.lit(0))), suffix, "tail")
    values = stored_rows(
        numbered.select(
            "hash_value", "head", "tail", F.substring(fitted, 1, max_length).alias("replacement_value")
        )
    )
    mark = separator.replace(".", r"\.")
    while True:
        first = values.groupBy("replacement_value").agg(
            F.min("hash_value").alias("_first"), F.count("*").alias("_n")
        )
        known = taken.withColumn("_stored", F.lit(True))
        met = stored_rows(
            first.join(known, "replacement_value", "left").where((F.col("_n") > 1) | F.col("_stored"))
        )
        if met.isEmpty():
            return values.select("hash_value", "replacement_value")
        digits = len(str(values.count() + taken.count())) + 1
        judged = values.join(met, "replacement_value", "left")
        again = F.col("_n").isNotNull() & (
            F.col("_stored").isNotNull() | (F.col("hash_value") != F.col("_first"))
        )
        stays = judged.where(~again).select(*values.columns)
        space = max_length - len(separator) - digits
        if space < 0:
            raise ValueError(f"max_length {max_length} cannot hold distinct values")
        fits = F.length("tail") <= space
        moved = judged.where(again).select(
            "hash_value",
            "head",
            F.when(fits, F.col("tail")).otherwise("").alias("tail"),
            F.substr(
                "head", F.lit(1), F.lit(space) - F.when(fits, F.length("tail")).otherwise(0)
            ).alias("_stem"),
        )
        in_use = stays.select("replacement_value").union(taken)
        ends = moved.select("tail").distinct()
        # A tail is an address's domain or a mark: as few as the pools have.
        used = (
            in_use.join(ends, F.endswith("replacement_value", F.col("tail")))
            .select(
                "tail",
                F.substr(
                    "replacement_value",
                    F.lit(1),
                    F.length("replacement_value") - F.length("tail"),
                ).alias("_body"),
            )
            .select(
                "tail",
                F.regexp_extract("_body", rf"^(.*){mark}\d+$", 1).alias("_stem"),
                F.regexp_extract("_body", rf"{mark}(\d+)$", 1).try_cast("long").alias("_number"),
            )
            .groupBy("_stem", "tail")
            .agg(F.max("_number").alias("_used"))
        )
        turn = F.row_number().over(Window.partitionBy("_stem", "tail").orderBy("hash_value"))
        number = F.coalesce(F.col("_used"), F.lit(1)) + F.col("_turn")
        renumbered = (
            moved.withColumn("_turn", turn)
            .join(used, ["_stem", "tail"], "left")
            .select(
                "hash_value",
                "head",
                "tail",
                F.concat("_stem", F.lit(separator), number, "tail").alias("replacement_value"),
            )
        )
        values = stored_rows(stays.unionByName(renumbered))


def _options(pii: Mapping[str, object] | Sequence[str]) -> dict[str, dict]:
    """Config per column, as a dict of overrides; ``True`` means defaults."""
    if not isinstance(pii, Mapping):
        return {name: {} for name in pii}
    options: dict[str, dict] = {}
    for name, value in pii.items():
        if value is True:
            options[name] = {}
        elif isinstance(value, Mapping):
            options[name] = dict(value)
        else:
            warnings.warn(f"PII config of {name!r} is neither True nor a dict; skipped", stacklevel=3)
    return options


def anonymize(
    df: DataFrame,
    pii: Mapping[str, object] | Sequence[str],
    source_system: str,
    context: str | None = None,
    mapping: DataFrame | None = None,
    *,
    enabled: bool = True,
    run_time: Column | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Replace the configured columns; also return the mapping rows to be appended.

    A stored replacement wins over a newly made one. Nulls stay null, absent
    columns are skipped. Prefix-and-hash replacements follow from the hash alone,
    so a column without stored mappings needs no join at all.
    """
    spark = df.sparkSession
    new_rows = empty_mapping(spark)
    if not enabled:
        return df, new_rows
    scope_context = normal_context(context)
    stamp = run_time if run_time is not None else F.current_timestamp()
    out = df
    for name, cfg in _options(pii).items():
        if name not in df.columns:
            continue
        algorithm = str(cfg.get("hash_algorithm", "SHA256")).upper()
        max_length = int(cfg.get("max_length", 64))
        field_type = cfg.get("field_type")
        realistic = bool(field_type) and str(field_type).strip().lower() in FIELD_TYPES
        raw = F.col(quoted(name))
        hashed = F.when(
            raw.isNotNull(),
            one_way_hash(pii_normal_form(raw, df.schema[name].dataType), algorithm),
        )
        derived = None
        if not realistic:
            derived = prefixed_text(
                F.col("hash_value"), name, cfg.get("replacement_prefix"), max_length
            )
        hashes = df.select(hashed.alias("hash_value")).where("hash_value IS NOT NULL").distinct()
        scope = None
        if mapping is not None:
            same_field = mapping.where(
                (F.col("source_system") == source_system)
                & (F.col("field_name") == name)
                & (F.col("context") == scope_context)
            )
            scope = same_field.where(F.col("hash_algorithm") == algorithm).select(
                "hash_value", "replacement_value"
            )
            hashes = hashes.join(scope.select("hash_value"), "hash_value", "left_anti")
        if realistic:
            taken = (same_field if mapping is not None else new_rows).select("replacement_value")
            fresh = unique_realistic(hashes, taken, field_type, max_length, cfg.get("locale"))
            scope = fresh if scope is None else scope.unionByName(fresh)
        else:
            fresh = hashes.select("hash_value", derived.alias("replacement_value"))
        new_rows = new_rows.unionByName(
            fresh.select(
                F.lit(source_system).alias("source_system"),
                F.lit(name).alias("field_name"),
                F.lit(scope_context).alias("context"),
                F.lit(algorithm).alias("hash_algorithm"),
                "hash_value",
                "replacement_value",
                stamp.alias("created_at"),
                stamp.alias("updated_at"),
            )
        )
        out = _replace(out, name, hashed, scope, derived)
    return out, new_rows


def _replace(
    df: DataFrame, name: str, hashed: Column, scope: DataFrame | None, derived: Column | None
) -> DataFrame:
    columns = df.columns
    if scope is None:
        made = df.withColumn("hash_value", hashed).withColumn(
            name, F.when(F.col("hash_value").isNotNull(), derived)
        )
        return made.select(*[quoted(c) for c in columns])
    # Null values match nothing; give them spread-out keys so that they do not
    # all meet in one shuffle partition.
    spread = F.concat(F.lit("~"), F.pmod(F.xxhash64(*[quoted(c) for c in columns]), F.lit(4096)))
    keyed = df.withColumn("_hash", hashed).withColumn("_key", F.coalesce("_hash", spread))
    lookup = scope.select(F.col("hash_value").alias("_key"), "replacement_value")
    joined = keyed.join(lookup, "_key", "left").withColumn("hash_value", F.col("_hash"))
    replacement = F.col("replacement_value")
    if derived is not None:
        replacement = F.coalesce(replacement, F.when(F.col("_hash").isNotNull(), derived))
    return joined.withColumn(name, replacement).select(*[quoted(c) for c in columns])
