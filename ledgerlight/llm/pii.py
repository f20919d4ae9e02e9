"""Personal data and secrets replaced by surrogates, in DataFrame functions only.

Detected entities (email, phone, card, IPv4, social security number, IBAN,
secret, titled person names) are replaced by keyed surrogates of their type and
format: digits stay digits, letters keep case and script, separators and
prefixes stay; cards keep their issuer digit and a valid Luhn sum. A surrogate depends
only on type, normalised entity and key (HMAC-SHA-256 of the first two under the third,
which the caller must give), so one entity has one surrogate in the whole corpus
(coreference), however it is written.

Names: a given name (the first of two) takes the gender of its title, and where the title
tells none (Dr, Prof) that of the list of given names. Where neither tells it, a person
is the one of equal name that other texts name with a title of one gender; if they use
titles of both genders, it is a third person. A name of one part is taken for a surname,
whose surrogate is the same for all genders (listed given names excepted).

Distinctness is checked over all documents: distinct entities are collected by
aggregation, and an entity whose surrogate is another's, or is an entity of the corpus itself,
is derived anew with the next attempt number until all differ. Surrogates of names, emails and
secrets get longer from the third attempt on, so their space grows; the other types keep their
length, and a corpus with more distinct entities than their format holds is refused.
Only entities told by other texts or derived anew (few: the spaces are large) come as a
table; only documents that hold one are joined with it, all others are rewritten in one
scan without a shuffle. Entities are extracted once and written with their documents.

Defined cases: null texts stay null, empty ones empty; repeated rows are
rewritten alike; other columns pass through unchanged; texts without entities come back
as they are; an empty table gives an empty result; an empty key is refused.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import apart, written

#: The session setting that holds the key, and the key of trials without one (no secret).
KEY_SETTING, TRIAL_KEY = "spark.ledgerlight.surrogate.key", "trial"
MAX_ATTEMPTS = 40

# Titles by gender (f, m, none), and given names that tell a gender.
TITLES = {"f": ("Mrs", "Ms", "Miss", "Frau", "Mme", "Mlle", "Sra", "Srta", "Госпожа"),
          "m": ("Mr", "Herr", "Monsieur", "Señor", "Господин"), "": ("Dr", "Prof")}
FEMALE = ("Anna", "Maria", "Mary", "Sarah", "Emma", "Laura", "Julia", "Sophie", "Claire", "Carmen", "Elena", "Lucia", "Анна", "Мария", "Елена")
MALE = ("John", "James", "Peter", "Paul", "Thomas", "Hans", "Karl", "Pierre", "Jean", "Juan", "Carlos", "Иван", "Пётр", "Сергей")

_NAME = r"[\p{Lu}][\p{Ll}]+(?:-[\p{Lu}][\p{Ll}]+)?"
_EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+){0,8}\.[A-Za-z]{2,}"
_SECRET = (r"(?<![A-Za-z0-9])(?i:password|passwd|pwd|secret|token|api[_-]?key)\s*[=:]\s*[\"']?[A-Za-z0-9+/_.-]{6,}"
           r"|(?<![A-Za-z0-9])(?:AKIA|ASIA)[0-9A-Z]{16}(?![0-9A-Za-z])|(?<![A-Za-z0-9])(?:ghp_|sk-)[A-Za-z0-9]{20,}+")
_IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"
_CARD = r"(?<![0-9A-Za-z])[0-9](?:[ -]?[0-9]){12,18}(?![0-9A-Za-z])"
_PHONE = (r"(?<![0-9A-Za-z])\+[0-9]{1,3}[ .-]?\(?[0-9]{2,4}\)?(?:[ .-]?[0-9]{2,4}){2,4}(?![0-9])"
          r"|(?<![0-9A-Za-z])(?:\([0-9]{3}\) ?|[0-9]{3}[.-])[0-9]{3}[ .-][0-9]{4}(?![0-9])")
_SSN = r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
_IP = rf"(?<![0-9A-Za-z.])(?:{_OCTET}\.){{3}}{_OCTET}(?![0-9]|\.[0-9])"
_TITLE = "|".join(t for g in TITLES.values() for t in g)
_PERSON = rf"(?<![\p{{L}}])(?:{_TITLE})\.? {_NAME}(?: {_NAME})?(?![\p{{L}}])"
#: In this order an entity's type is told.
TYPES = (("email", _EMAIL), ("secret", _SECRET), ("iban", _IBAN), ("card", _CARD), ("ssn", _SSN), ("phone", _PHONE), ("ip", _IP), ("name", _PERSON))
_ANY = "|".join(f"(?:{p})" for _, p in TYPES)
#: Stands between a given name and its gender in a normalised name.
_TELLS = "\x1d"
#: A cheap test that every entity passes: an @, a digit pair, a secret's word or a title.
_MAYBE = rf"@|[0-9][^\p{{L}}]{{0,3}}[0-9]|(?i:password|passwd|pwd|secret|token|key)|AKIA|ASIA|sk-|ghp_|(?:{_TITLE})\.? \p{{Lu}}"


def entities(text: Column) -> Column:
    return F.when(F.rlike(text, F.lit(_MAYBE)), F.regexp_extract_all(text, F.lit(f"({_ANY})"), F.lit(1))).otherwise(F.array().cast("array<string>"))


def kind_of(entity: Column) -> Column:
    return F.coalesce(*[F.when(F.rlike(entity, F.lit(f"^(?:{p})$")), F.lit(t)) for t, p in TYPES], F.lit("phone"))


def _secret_prefix(entity: Column) -> Column:
    """What is not secret: the word before the value, or the key's kind."""
    return F.regexp_extract(entity, r"^((?i:password|passwd|pwd|secret|token|api[_-]?key)\s*[=:]\s*[\"']?|AKIA|ASIA|ghp_|sk-)", 1)


def _name_parts(entity: Column) -> Column:
    """The parts after the title; the first of two with its gender, if one is told."""
    parts = F.slice(F.split(entity, " "), 2, 9)
    title = F.regexp_replace(F.substring_index(entity, " ", 1), r"\.$", "")
    given = F.get(parts, F.lit(0))
    gender = F.when(title.isin(*TITLES["f"]), "f").when(title.isin(*TITLES["m"]), "m").otherwise(_gender_of_name(given))
    return F.transform(parts, lambda p, i: F.when((i == 0) & (F.size(parts) > 1) & (gender != ""), F.concat(p, F.lit(_TELLS), gender)).otherwise(p))


def _without_gender(norm: Column) -> Column:
    return F.regexp_replace(norm, f"{_TELLS}[fm]", "")


def normal(entity: Column, kind: Column) -> Column:
    """The entity without the ways to write it: case of emails, separators of numbers."""
    return (F.when(kind == "email", F.lower(entity))
            .when(kind.isin("card", "ssn", "phone"), F.regexp_replace(entity, r"[^0-9+]", ""))
            .when(kind == "iban", F.replace(entity, F.lit(" "), F.lit("")))
            .when(kind == "secret", F.substring(entity, F.length(_secret_prefix(entity)) + 1, F.length(entity)))
            .when(kind == "name", F.array_join(_name_parts(entity), " "))
            .otherwise(entity))


def _extend(rows: Column, name: str, value) -> Column:
    """An array of structs with one more field: each step is evaluated once and
    the next ones refer to it."""
    return F.transform(rows, lambda r: r.withField(name, value(r)))


def _stream(key: str, kind: Column, norm: Column, attempt: Column) -> Column:
    """64 hex digits: HMAC-SHA-256, under the key, of type, entity and attempt."""
    secret = key.encode()
    secret = (secret if len(secret) <= 64 else hashlib.sha256(secret).digest()).ljust(64, b"\0")
    inner, outer = (F.lit(bytes(b ^ pad for b in secret)) for pad in (0x36, 0x5C))
    message = F.encode(F.concat_ws("\x1f", kind, norm, attempt.cast("string")), "UTF-8")
    return F.sha2(F.concat(outer, F.unhex(F.sha2(F.concat(inner, message), 256))), 256)


_DIGITS = ("abcdef", "279415")
_LOWER = ("0123456789", "kqzvbxwjhm")


def _like(text: Column, r: Column) -> Column:
    """``text`` with its ASCII letters and digits replaced, place by place, from the
    row's streams; 64 places, then again."""
    def char(c: Column, i: Column) -> Column:
        at = F.pmod(i, F.lit(64)) + 1
        return (F.when(F.rlike(c, F.lit("[0-9]")), F.substring(r["digits"], at, F.lit(1)))
                .when(F.rlike(c, F.lit("[a-z]")), F.substring(r["lower"], at, F.lit(1)))
                .when(F.rlike(c, F.lit("[A-Z]")), F.upper(F.substring(r["lower"], at, F.lit(1)))).otherwise(c))

    return F.array_join(F.transform(F.split(text, ""), char), "")


def _hex_like(text: Column, r: Column) -> Column:
    """Like ``_like``, but hex stays hex."""
    wide = F.substring(F.repeat(r["stream"], (F.length(text) / 64 + 1).cast("int")), F.lit(1), F.length(text))
    return (F.when(F.rlike(text, F.lit("^[0-9a-f]+$")), wide).when(F.rlike(text, F.lit("^[0-9A-F]+$")), F.upper(wide)).otherwise(_like(text, r)))


def _luhn_sum(digits: Column) -> Column:
    """Luhn sum of a string of digits, the last one counted once."""
    each = F.transform(F.split(F.reverse(digits), ""), lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(
        F.when(c.cast("int") * 2 > 9, c.cast("int") * 2 - 9).otherwise(c.cast("int") * 2)))
    return F.aggregate(each, F.lit(0), lambda a, x: a + x)


def _card(r: Column) -> Column:
    """The issuer's digit stays; the last digit makes a valid Luhn sum if, and only if, the original's is."""
    norm = r["norm"]
    body = F.concat(F.substring(norm, 1, 1), _like(F.substring(norm, F.lit(2), F.length(norm) - 2), r))
    check = F.pmod(F.lit(10) - F.pmod(_luhn_sum(F.concat(body, F.lit("0"))), F.lit(10)), F.lit(10))
    valid = F.pmod(_luhn_sum(norm), F.lit(10)) == 0
    other = F.pmod(check + 1 + F.conv(F.substring(r["stream"], 60, 1), 16, 10).cast("int") % 8, F.lit(10))
    return F.concat(body, F.when(valid, check).otherwise(other).cast("string"))


def _phone(r: Column) -> Column:
    """The country code stays (before the last ten digits), the first digit after it is neither 0 nor 1."""
    norm = r["norm"]
    head = F.when(norm.startswith("+"), F.substring(norm, F.lit(1), F.greatest(F.lit(2), F.length(norm) - 10))).otherwise(F.lit(""))
    tail = _like(F.substring(norm, F.length(head) + 1, F.length(norm)), r)
    return F.concat(head, F.translate(F.substring(tail, 1, 1), "01", "38"), F.substring(tail, F.lit(2), F.length(tail)))


def _ip(r: Column) -> Column:
    stream = r["stream"]

    def octet(i: int, low: int, n: int) -> Column:
        return (F.lit(low) + F.pmod(F.conv(F.substring(stream, 1 + 6 * i, 6), 16, 10).cast("long"), F.lit(n))).cast("string")
    return F.concat_ws(".", octet(0, 1, 223), octet(1, 0, 256), octet(2, 0, 256), octet(3, 1, 254))


# Syllables that surrogate names are made of, by script, and endings by gender.
_SYLLABLES = {"Latin": "ba da fa ga ka la ma na ra sa ta va bo do lo mo no ro so to be de le me ne re se te vi li mi ni".split(),
              "Cyrillic": "ба да га ка ла ма на ра са та ва бо до ло мо но ро со то бе де ле ме не ре се те ви ли ми ни".split()}
_ENDS = {"Latin": {"f": "na", "m": "rt", "": "l"}, "Cyrillic": {"f": "на", "m": "рт", "": "л"}}


def _word_name(stream: Column, script: str, n: int) -> Column:
    table = F.array(*[F.lit(s) for s in _SYLLABLES[script]])
    pick = [F.element_at(table, (F.pmod(F.conv(F.substring(stream, 1 + 4 * i, 4), 16, 10).cast("int"), F.lit(len(_SYLLABLES[script]))) + 1).cast("int")) for i in range(n)]
    return F.concat(*pick)


def _one_name(part: Column, key: str, gender: Column, attempt: Column) -> Column:
    stream = _stream(key, F.lit("name"), part, attempt)

    def made(script: str) -> Column:
        end = F.when(gender == "f", _ENDS[script]["f"]).when(gender == "m", _ENDS[script]["m"]).otherwise(_ENDS[script][""])
        stem = F.when(attempt > 2, _word_name(stream, script, 4 + 8)).otherwise(_word_name(stream, script, 4))
        return F.initcap(F.concat(stem, end))

    return F.when(F.rlike(part, F.lit(r"\p{IsCyrillic}")), made("Cyrillic")).otherwise(made("Latin"))


def _gender_of_name(part: Column) -> Column:
    return F.when(part.isin(*FEMALE), "f").when(part.isin(*MALE), "m").otherwise("")


def _name(norm: Column, key: str, attempt: Column) -> Column:
    """Each part of the name: the same part has the same surrogate in every
    name but for the ending that tells its gender. Only attempts after the first depend on the whole name."""
    whole = F.when(attempt > 0, F.concat(F.lit("\x1e"), norm)).otherwise(F.lit(""))

    def part(p: Column) -> Column:
        plain, told = F.substring_index(p, _TELLS, 1), F.contains(p, F.lit(_TELLS))
        return _one_name(F.concat(plain, whole), key, F.when(told, F.substring(p, -1, 1)).otherwise(_gender_of_name(plain)), attempt)

    return F.array_join(F.transform(F.split(norm, " "), part), " ")


def surrogates(rows: Column, key: str) -> Column:
    """Array of structs with kind, norm and attempt to the same with ``new``, the
    normalised surrogate."""
    rows = _extend(rows, "stream", lambda r: _stream(key, r["kind"], r["norm"], r["attempt"]))
    rows = _extend(rows, "digits", lambda r: F.translate(r["stream"], *_DIGITS))
    rows = _extend(rows, "lower", lambda r: F.translate(r["stream"], *_LOWER))

    def new(r: Column) -> Column:
        kind, norm = r["kind"], r["norm"]
        local, domain = F.substring_index(norm, "@", 1), F.substring_index(norm, "@", -1)
        site = F.substring(F.translate(_stream(key, F.lit("domain"), domain, F.lit(0)), *_LOWER), 1, 8)
        # A short space (one letter and the like) is widened after the first attempts.
        more = F.when(r["attempt"] > 2, F.substring(r["lower"], 41, 6)).otherwise(F.lit(""))
        return (F.when(kind == "email", F.concat(_like(local, r), more, F.lit("@"), site, F.lit(".example."), F.substring_index(domain, ".", -1)))
                .when(kind == "secret", F.concat(_hex_like(norm, r), more))
                .when(kind == "iban", F.concat(F.substring(norm, 1, 2), _like(F.substring(norm, F.lit(3), F.length(norm)), r)))
                .when(kind == "card", _card(r)).when(kind == "phone", _phone(r)).when(kind == "ip", _ip(r))
                .when(kind == "name", _name(norm, key, r["attempt"])).otherwise(_like(norm, r)))

    return _extend(rows, "new", new)


def _fill(pattern: Column, norm: Column) -> Column:
    """The characters of ``norm`` in the places of letters, digits and + of ``pattern``."""
    def char(c: Column, i: Column) -> Column:
        place = F.length(F.regexp_replace(F.substring(pattern, F.lit(1), i + 1), "[^0-9A-Za-z+]", ""))
        return F.when(F.rlike(c, F.lit("[0-9A-Za-z+]")), F.substring(norm, place, F.lit(1))).otherwise(c)
    return F.array_join(F.transform(F.split(pattern, ""), char), "")


def written_like(r: Column) -> Column:
    """The surrogate ``new`` as the entity was written."""
    entity, kind, new = r["entity"], r["kind"], r["new"]
    upper = (F.upper(entity) == entity) & (F.lower(entity) != entity)
    return (F.when(kind == "email", F.when(upper, F.upper(new)).otherwise(new))
            .when(kind == "secret", F.concat(_secret_prefix(entity), new))
            .when(kind.isin("card", "phone", "ssn", "iban"), _fill(entity, new))
            .when(kind == "name", F.concat(F.substring_index(entity, " ", 1), F.lit(" "), new)).otherwise(new))


def described(found: Column) -> Column:
    """Entities to structs of entity, kind and norm."""
    rows = F.transform(found, lambda e: F.struct(e.alias("entity"), kind_of(e).alias("kind")))
    return _extend(rows, "norm", lambda r: normal(r["entity"], r["kind"]))


def _rewritten(text: Column, rows: Column, changes: Column | None, key: str) -> Column:
    """``text`` with each of its entities replaced. ``changes``: map of type
    and entity to the entity it stands for and the attempt, where it is not itself or not the first."""
    def changed(r: Column) -> Column:
        at = F.lit(None).cast("struct<to:string,attempt:int>") if changes is None else F.try_element_at(changes, F.concat_ws("\x1f", r["kind"], r["norm"]))
        return r.withField("attempt", F.coalesce(at["attempt"], F.lit(0))).withField("norm", F.coalesce(at["to"], r["norm"]))

    parts = F.transform(surrogates(F.transform(rows, changed), key), written_like)
    both = F.zip_with(F.split(text, _ANY, -1), parts, lambda a, b: F.concat(a, F.coalesce(b, F.lit(""))))
    return F.when(F.size(rows) > 0, F.array_join(both, "")).otherwise(text)


def _told_elsewhere(known: DataFrame) -> DataFrame:
    """(type, entity, to) of the names without gender whose like other texts name with one gender."""
    names = known.where("kind = 'name'").withColumn("plain", _without_gender(F.col("norm")))
    told = names.where("norm <> plain").groupBy("plain").agg(F.min("norm").alias("to"), F.max("norm").alias("last")).where("to = last")
    return names.where("norm = plain").join(told.select("plain", "to"), "plain").select("kind", "norm", "to")


def _retries(known: DataFrame, key: str) -> DataFrame:
    """(type, entity, attempt) of the entities whose first surrogate is taken."""
    def derived() -> Column:
        return F.get(surrogates(F.array(F.struct("kind", "norm", "attempt")), key), F.lit(0))["new"]

    now = known.withColumn("attempt", F.lit(0))
    now = written(now.withColumn("new", derived()), "pii-surrogates")
    for _ in range(MAX_ATTEMPTS):
        owners = written(now.groupBy("kind", "new").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("attempt", "norm")).alias("first"))
                         .where("n > 1").select("kind", "new", F.col("first.norm").alias("owner")), "pii-owners")
        shared = now.join(owners, ["kind", "new"]).where("owner <> norm").select("kind", "norm")
        real = now.join(known.select("kind", _without_gender(F.col("norm")).alias("new")), ["kind", "new"], "left_semi").select("kind", "norm")
        lost = written(shared.unionByName(real).distinct().withColumn("lost", F.lit(1)), "pii-lost")
        if lost.isEmpty():
            return now.where("attempt > 0").select("kind", "norm", "attempt")
        now = now.join(lost, ["kind", "norm"], "left").withColumn("attempt", F.col("attempt") + F.coalesce("lost", F.lit(0)))
        now = written(now.withColumn("new", F.when(F.col("lost") == 1, derived()).otherwise(F.col("new"))).drop("lost"), "pii-surrogates")
    raise RuntimeError("surrogates still collide; use a longer format")


def session_key(spark: SparkSession) -> str:
    """The key of the session's setting; for trials without one ``TRIAL_KEY``, which anyone can read."""
    return spark.conf.get(KEY_SETTING, None) or TRIAL_KEY


@apart
def pseudonymise(docs: DataFrame, key: str) -> DataFrame:
    """``docs`` with the entities of ``text`` replaced by surrogates under ``key``."""
    if not key:
        raise ValueError("surrogates need a key")
    marked = written(docs.withColumn("_rows", described(entities(F.col("text")))), "pii-marked")
    held = marked.where(F.size("_rows") > 0)
    known = written(held.select(F.explode("_rows").alias("r")).select("r.kind", "r.norm").distinct(), "pii-entities")
    told = written(_told_elsewhere(known), "pii-told")
    retries = _retries(known.join(told, ["kind", "norm"], "left_anti"), key)
    changes = retries.withColumn("to", F.col("norm")).select("kind", "norm", "to", "attempt").unionByName(
        told.join(retries.select("kind", F.col("norm").alias("to"), "attempt"), ["kind", "to"], "left")
        .select("kind", "norm", "to", F.coalesce("attempt", F.lit(0)).alias("attempt")))
    if changes.isEmpty():
        return marked.withColumn("text", _rewritten(F.col("text"), F.col("_rows"), None, key)).drop("_rows")
    # Documents that hold a changed entity get its change by a join on the text's hash:
    # that side is as small as the changed entities' documents, and Spark broadcasts or
    # shuffles it by its size.
    hash_of = F.when(F.size("_rows") > 0, F.xxhash64("text"))
    found = (held.select(hash_of.alias("_hash"), F.explode("_rows").alias("r"))
             .select("_hash", "r.kind", "r.norm").join(changes, ["kind", "norm"])
             .select("_hash", F.concat_ws("\x1f", "kind", "norm").alias("name"), F.struct("to", "attempt").alias("change")).distinct())
    maps = written(found.groupBy("_hash").agg(F.map_from_entries(F.collect_list(F.struct("name", "change"))).alias("_changes")), "pii-maps")
    out = marked.withColumn("_hash", hash_of).join(maps, "_hash", "left").withColumn(
        "text", _rewritten(F.col("text"), F.col("_rows"), F.col("_changes"), key))
    return out.select(*docs.columns)
