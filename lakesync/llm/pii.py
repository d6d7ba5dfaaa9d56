"""PII surrogates: entities replaced by keyed values of the same kind.

E-mail addresses, IPv4 addresses, payment cards, phone numbers and titled names
are found by patterns. An entity's normal form (letters and digits, lower case)
and the key give its surrogate: digits become digits, letters become letters of
the same case and script, separators stay; card numbers keep their Luhn
validity, address octets stay in range, and the given name after a title matches
its gender. E-mail domains become example domains unless they are such already.

All mentions of one normal form share the surrogate (coreference). Surrogates
that two entities share, or that equal a real entity, are drawn again with the
next nonce until none is left (distinctness). Short formats can run out of values:
names get a letter more after every ``LONGER_AFTER`` draws, and after
``AVOID_REAL`` draws a surrogate may equal a real entity, not another's. Null texts stay null; texts
without entities stay as they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

DEFAULT_KEY = "surrogates-1"
LONGER_AFTER = 8
AVOID_REAL = 16

# Entity patterns, titles by gender, given names by gender and script.
EMAIL = r"[\p{L}\p{N}._%+-]+@[\p{L}\p{N}-]+(?:\.[\p{L}\p{N}-]+)+"
IPV4 = r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\d]|\.\d)"
CARD = r"(?<!\d)(?:\d{4}[ -]?){3}\d{4}(?!\d)"
PHONE = r"(?<![\p{L}\d])\+?\d{1,3}[ .-]?\(?\d{2,4}\)?[ .-]\d{3,4}[ .-]?\d{3,4}(?!\d)"
FEMALE_TITLES = "Mrs|Ms|Miss|Frau|Mme|Señora|Sra|Госпожа"
MALE_TITLES = "Mr|Herr|Monsieur|Señor|Sr|Господин"
NAME = rf"(?<!\p{{L}})(?:{FEMALE_TITLES}|{MALE_TITLES})\.? \p{{Lu}}\p{{L}}+(?: \p{{Lu}}\p{{L}}+)?"
KINDS = (("email", EMAIL), ("ip", IPV4), ("card", CARD), ("phone", PHONE), ("name", NAME))
ANY = "|".join(f"(?:{p})" for _, p in KINDS)
GIVEN = {
    ("f", "latin"): "Anna Clara Elena Julia Laura Maria Nina Paula".split(),
    ("m", "latin"): "Adam Bruno Daniel Felix Hugo Leon Martin Paul".split(),
    ("f", "cyrillic"): "Анна Елена Ирина Мария Ольга".split(),
    ("m", "cyrillic"): "Антон Иван Максим Олег Павел".split(),
}


def _kind(col):
    out = F.lit("name")
    for kind, pattern in reversed(KINDS[:-1]):
        out = F.when(col.rlike(f"^(?:{pattern})$"), kind).otherwise(out)
    return out


def _normal(col):
    return F.lower(F.regexp_replace(col, r"[^\p{L}\p{N}@.]|(?<!\p{L})\.|\.(?!\p{L})", ""))


def _number(seed, at, below: int):
    """A keyed number from 0 to ``below`` - 1 for position ``at``."""
    return F.pmod(F.conv(F.substring(F.sha2(F.concat_ws("|", seed, at.cast("string")).cast("binary"), 256), 1, 12), 16, 10).cast("long"), F.lit(below))


def _pick(letters: str, n):
    return F.substr(F.lit(letters), (n + 1).cast("int"), F.lit(1))


def _letters(col, seed):
    """Characters replaced by class; the n-th letter or digit by stream value n,
    so differently written mentions agree."""
    chars = F.filter(F.split(col, ""), lambda c: c != "")

    def one(c, i):
        n = F.char_length(F.regexp_replace(F.substr(col, F.lit(1), i + 1), r"[^\p{L}\p{N}]", ""))
        return (F.when(c.rlike(r"^\d$"), _pick("0123456789", _number(seed, n, 10)))
                .when(c.rlike(r"^[\p{IsCyrillic}&&\p{Lu}]$"), _pick("АВЕИКЛМНОПРСТ", _number(seed, n, 13)))
                .when(c.rlike(r"^\p{IsCyrillic}$"), _pick("авеиклмнопрст", _number(seed, n, 13)))
                .when(c.rlike(r"^[\p{IsGreek}&&\p{Lu}]$"), _pick("ΑΒΓΔΕΚΛΜΝΟΠΡΣΤ", _number(seed, n, 14)))
                .when(c.rlike(r"^\p{IsGreek}$"), _pick("αβγδεκλμνοπρστ", _number(seed, n, 14)))
                .when(c.rlike(r"^\p{Lu}$"), _pick("ABCDEFGHIJKLMNOPQRSTUVWXYZ", _number(seed, n, 26)))
                .when(c.rlike(r"^\p{L}$"), _pick("abcdefghijklmnopqrstuvwxyz", _number(seed, n, 26)))
                .otherwise(c))
    return F.array_join(F.transform(chars, one), "")


def _luhn(digits):
    """Luhn sum modulo 10 of a string of digits."""
    ds = F.reverse(F.filter(F.split(digits, ""), lambda c: c != ""))
    doubled = F.transform(ds, lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(
        F.when(c.cast("int") * 2 > 9, c.cast("int") * 2 - 9).otherwise(c.cast("int") * 2)))
    return F.aggregate(doubled, F.lit(0), lambda a, x: a + x) % 10


def surrogate(entity, kind, normal, nonce, key: str):
    """The replacement of one mention."""
    seed = F.concat_ws("|", F.lit(key), kind, normal, nonce.cast("string"))
    drawn = _letters(entity, seed)
    domain = F.substring_index(entity, "@", -1)
    example = F.when(domain.rlike(r"(^|\.)example\.(com|org|net)$"), domain).otherwise(
        F.concat(F.lit("mail"), _number(seed, F.lit(-1), 9000) + 1000, F.lit(".example.org")))
    email = F.concat(_letters(F.substring_index(entity, "@", 1), seed), F.lit("@"), example)
    octet = lambda o, i: (F.when(F.char_length(o) == 1, _number(seed, i, 10)).when(F.char_length(o) == 2, _number(seed, i, 90) + 10)
                          .otherwise(_number(seed, i, 156) + 100)).cast("string")
    ip = F.array_join(F.transform(F.split(entity, r"\."), octet), ".")
    digits = F.regexp_replace(drawn, r"\D", "")
    check = F.pmod(F.substr(drawn, F.char_length(drawn)).cast("int") - _luhn(digits), F.lit(10)).cast("string")
    card = F.when(_luhn(F.regexp_replace(entity, r"\D", "")) == 0, F.concat(F.substr(drawn, F.lit(1), F.char_length(drawn) - 1), check)).otherwise(drawn)
    country = F.regexp_extract(entity, r"^\+\d", 0)
    phone = F.concat(country, F.substr(drawn, F.char_length(country) + 1))
    title, words = F.substring_index(entity, " ", 1), F.split(entity, " ")
    gender = F.when(title.rlike(f"^(?:{FEMALE_TITLES})"), "f").otherwise("m")
    script = F.when(entity.rlike(r"\p{IsCyrillic}$"), "cyrillic").otherwise("latin")
    given = F.lit("")
    for (g, s), names in GIVEN.items():
        given = F.when((gender == g) & (script == s), F.get(F.array(*map(F.lit, names)), _number(seed, F.lit(-2), len(names)).cast("int"))).otherwise(given)
    last = _letters(F.element_at(words, -1), seed)
    more = _letters(F.repeat(F.lit("n"), F.floor(nonce / LONGER_AFTER).cast("int")), F.concat(seed, F.lit("+")))
    last = F.concat(last, more)
    name = F.when(F.size(words) > 2, F.concat_ws(" ", title, given, last)).otherwise(F.concat_ws(" ", title, last))
    return F.when(kind == "email", email).when(kind == "ip", ip).when(kind == "card", card).when(kind == "phone", phone).otherwise(name)


def entity_map(mentions: DataFrame, key: str) -> DataFrame:
    """kind, normal and the nonce at which no two entities share a surrogate."""
    known = mentions.groupBy("kind", "normal").agg(F.min("entity").alias("entity"))
    known = stored(known.withColumn("nonce", F.lit(0)), "entities")
    while True:
        made = known.withColumn("made", _normal(surrogate(F.col("entity"), F.col("kind"), F.col("normal"), F.col("nonce"), key)))
        shared = made.groupBy("kind", "made").agg(F.min("normal").alias("first"), F.count("*").alias("n"))
        real = known.select("kind", F.col("normal").alias("made")).withColumn("real", F.lit(True))
        judged = made.join(shared, ["kind", "made"]).join(real, ["kind", "made"], "left")
        clash = ((F.col("n") > 1) & (F.col("normal") != F.col("first"))) | (F.col("real").isNotNull() & (F.col("nonce") < AVOID_REAL))
        known = stored(judged.select("kind", "normal", "entity", (F.col("nonce") + clash.cast("int")).alias("nonce"), clash.alias("clash")), "entities")
        if not known.where("clash").head(1):
            return known.select("kind", "normal", "nonce")
        known = known.drop("clash")


def replace_pii(docs: DataFrame, key: str = DEFAULT_KEY) -> DataFrame:
    """doc_id, text with surrogates, and the number of mentions replaced."""
    d = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    d = d.withColumn("row_key", F.xxhash64("doc_id", "text")).withColumn("found", F.coalesce(
        F.regexp_extract_all("text", F.lit(ANY), F.lit(0)), F.array().cast("array<string>")))
    d = stored(d.select("doc_id", "text", "row_key", "found"), "found")
    hit = d.where(F.size("found") > 0)
    mentions = hit.dropDuplicates(["row_key"]).select("row_key", F.posexplode("found").alias("pos", "entity"))
    mentions = stored(mentions.withColumn("kind", _kind(F.col("entity"))).withColumn("normal", _normal(F.col("entity"))), "mentions")
    drawn = mentions.join(entity_map(mentions, key), ["kind", "normal"]) \
        .withColumn("made", surrogate(F.col("entity"), F.col("kind"), F.col("normal"), F.col("nonce"), key))
    per_row = drawn.groupBy("row_key").agg(F.sort_array(F.collect_list(F.struct("pos", "made"))).alias("made"))
    gaps = F.split("text", ANY, -1)
    text = F.array_join(F.transform(F.arrays_zip(gaps.alias("gap"), F.col("made.made").alias("made")),
                                    lambda z: F.concat(z["gap"], F.coalesce(z["made"], F.lit("")))), "")
    done = hit.join(per_row, "row_key").select("doc_id", text.alias("text"), F.size("found").alias("n_replaced"))
    return done.unionByName(d.where(F.size("found") == 0).select("doc_id", "text", F.lit(0).alias("n_replaced")))
