"""PII surrogates: detected entities become keyed, type-consistent stand-ins.
DataFrame and SQL functions only.

Detection. One pattern finds e-mail addresses, phone numbers (grouped, with a
country code, or national with a leading zero: 8 to 15 digits), IPv4 and IPv6
addresses, card numbers (13 to 19 digits that pass the Luhn check), national
ids, IBANs, access keys, long hexadecimal secrets, values set to a password,
secret, api_key or token by ``=`` or ``:`` with or without quotes (without
``=`` and quotes only values with a digit), and names of up to three parts,
with particles, after a form of address (Latin, Cyrillic, Greek).

Surrogates. An entity's normal form (digits of a number, lower case of an
address) and a secret key give a hash; each character is drawn from it within
its own class, so lengths, separators and character sets stay. E-mail domains
become names below ``example``; phone country codes, card and IBAN prefixes
and octet widths stay, card numbers pass the Luhn check again; a name keeps
its script, its number of parts and its letter case, a given name the gender
of the form of address, and a family name maps alike with and without a given
name before it.

Collisions. The surrogates of all distinct entities are checked against each
other and against every real entity of the corpus; those that clash draw
again with the next attempt number until none does. So distinct entities stay
distinct, and one entity gets one surrogate wherever it occurs. Family names
are settled first, as entities of their own that every full name looks up.
Each further attempt adds a syllable to a name, and from the seventh attempt a
character to any other surrogate, so no shape runs out, however many of its
values are real.

Only documents that hold an entity are taken apart and joined; the others pass
through. Occurrences meet their surrogate in a plain join on the entity, which
Spark may split when one entity is very common; the texts are put together
again from the pieces between the matches.

Defined cases: null and empty texts and texts without an entity are returned
unchanged; repeated rows stay repeated; every other column is kept as it is
(``n_chars``, when there is one, follows the new text).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stage

# Fixed lists: forms of address by gender, given names by script and gender,
# syllables for family names by script.
ADDRESS = {
    "f": ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra", "Госпожа", "Κυρία"),
    "m": ("Mr", "Herr", "Monsieur", "Señor", "Sr", "Господин", "Κύριος"),
}
GIVEN = {
    ("latin", "f"): ("Anna", "Clara", "Elena", "Helen", "Irene", "Julia", "Laura", "Maria", "Nora", "Paula", "Sara", "Vera"),
    ("latin", "m"): ("Adam", "Bruno", "Daniel", "Emil", "Hugo", "Jonas", "Leon", "Martin", "Oscar", "Paul", "Simon", "Victor"),
    ("cyrillic", "f"): ("Анна", "Вера", "Елена", "Ирина", "Мария", "Нина", "Ольга", "Софья"),
    ("cyrillic", "m"): ("Антон", "Борис", "Иван", "Марк", "Олег", "Павел", "Роман", "Юрий"),
    ("greek", "f"): ("Άννα", "Δάφνη", "Ελένη", "Ιωάννα", "Μαρία", "Σοφία"),
    ("greek", "m"): ("Ανδρέας", "Γιώργος", "Ηλίας", "Νίκος", "Παύλος", "Πέτρος"),
}
SYLLABLES = {
    "latin": ("bar", "den", "fal", "gor", "hal", "ken", "lan", "mer", "nor", "pel", "ran", "sol", "tor", "ver", "wil", "zan"),
    "cyrillic": ("бар", "вол", "гор", "дан", "кор", "лан", "мир", "нов", "пет", "рад", "сол", "тар"),
    "greek": ("βασ", "γαλ", "δημ", "καρ", "λαμ", "μαν", "παπ", "ροδ", "σταν", "τσακ"),
}
_ALPHABETS = {
    "a-z": "abcdefghijklmnopqrstuvwxyz", "A-Z": "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "а-я": "абвгдежзийклмнопрстуфхцчшщыэюя", "А-Я": "АБВГДЕЖЗИЙКЛМНОПРСТУФХЦЧШЩЫЭЮЯ",
    "α-ω": "αβγδεζηθικλμνξοπρστυφχψω", "Α-Ω": "ΑΒΓΔΕΖΗΘΙΚΛΜΝΞΟΠΡΣΤΥΦΧΨΩ",
}

_EDGE, _END = r"(?<![\p{L}\p{N}])", r"(?![\p{L}\p{N}])"
_NAME = r"\p{Lu}[\p{L}'’-]++"
_FORMS = "|".join(x for xs in ADDRESS.values() for x in xs)
_INITIALS = "".join(sorted({x[0] for xs in ADDRESS.values() for x in xs}))
#: A key's name and what may stand between it and its value.
_SET = r"(?i:password|passwd|secret|api_key|token)"
_ASSIGN = r"[\"']? ?[:=] ?"
#: Parts of a name that stand in lower case.
PARTICLES = ("von", "van", "de", "der", "den", "da", "di", "del", "la", "le", "du", "dos", "bin", "al")
_MORE = rf"(?: (?:(?:{'|'.join(PARTICLES)}) ){{0,3}}{_NAME}){{0,2}}+"
PARTS = {
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[\p{L}\p{N}-]++(?:\.[\p{L}\p{N}-]++)++",
    "secret": rf"""{_SET}(?:=[^\s"',;]{{6,}}+|{_ASSIGN}(?=[^\s"',;]*\d)[^\s"',;]{{6,}}+|{_ASSIGN}["'][^\s"']{{6,}}+)""",
    "phone": r"(?<![\p{L}\p{N}])(?:\+\d{1,3}[ .-]?)?+(?:\(\d{2,4}\) ?|\d{3}[ .-])\d{3,4}[ .-]\d{4}(?!\d)",
    "e164": r"(?<![\p{L}\p{N}+])\+[1-9]\d{0,2}(?:[ .-]?\(?\d{1,4}\)?){2,6}+(?![\p{L}\p{N}])",
    "national": r"(?<![\p{L}\p{N}+.-])0\d{2,4}[ /]\d{3,4}(?:[ -]?\d{2,4}){1,2}+(?![\p{L}\p{N}])",
    "ipv6": r"(?<![\p{L}\p{N}:])(?=[0-9A-Fa-f:]*\d)(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}|(?:[0-9A-Fa-f]{1,4}:){1,6}(?::[0-9A-Fa-f]{1,4}){1,6})(?![\p{L}\p{N}:])",
    "ip": r"(?<![\p{L}\p{N}.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1\d\d|\d?\d)(?!\.?[\p{L}\p{N}])",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "iban": _EDGE + r"[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?" + _END,
    "card": _EDGE + r"\d(?:[ -]?\d){12,18}" + _END,
    "access": _EDGE + r"(?:AKIA|ASIA)[A-Z0-9]{16}" + _END,
    "hex": _EDGE + r"(?:(?=\d*[a-f])(?=[a-f]*\d)[0-9a-f]{16,128}|(?=\d*[A-F])(?=[A-F]*\d)[0-9A-F]{16,128})" + _END,
    "name": rf"(?=[{_INITIALS}])(?<!\p{{L}})(?:{_FORMS})\.? (?:(?:{'|'.join(PARTICLES)}) ){{0,3}}{_NAME}{_MORE}",
}
PATTERN = "|".join(PARTS.values())
#: What stands before the part of a match that is replaced.
LEAD = rf"^(?:(?:{_FORMS})\.? |{_SET}{_ASSIGN}[\"']?)"
#: Every match of PATTERN holds one of these; a text without them is passed by.
HINT = rf"@|\d[ .-]?\d|[0-9a-f]{{16}}|[0-9A-F]{{16}}|AKIA|ASIA|(?i:password|passwd|secret|api_key|token)[\"']? ?[=:]|[0-9A-Fa-f]::?[0-9A-Fa-f]|(?=[{_INITIALS}])(?:{_FORMS})\.? "
#: Kinds whose surrogate replaces letters and digits in place.
_POURED = ("phone", "ssn", "iban", "card")
#: Attempts within an entity's own shape; each one after adds a character, so
#: that also shapes with few values, most of them real, come to an end.
_IN_SHAPE = 6


def _kind(entity: Column) -> Column:
    """Kind of a match; a digit run that is no card number has none. A match
    with a lead is a name or a secret."""
    lead = F.regexp_extract(entity, LEAD, 0)
    whole = {k: entity.rlike(rf"^(?:{p})$") for k, p in PARTS.items() if k not in ("secret", "name")}
    digits = F.regexp_replace(entity, r"\D", "")
    kind = F.when(lead.rlike(rf"^{_SET}"), "secret").when(lead != "", "name")
    for k in ("email", "phone", "e164", "national", "ip", "ipv6", "ssn", "iban", "card", "access", "hex"):
        hit = whole[k] & (_luhn(digits) % 10 == 0) if k == "card" else whole[k]
        if k in ("e164", "national"):  # grouped at will: as many digits as a number has
            hit = hit & F.length(digits).between(8, 15)
        kind = kind.when(hit, "phone" if k in ("e164", "national") else k)
    return kind


def _luhn(digits: Column) -> Column:
    """Luhn sum of a digit string."""
    doubled = F.transform(F.split(F.reverse(digits), ""), lambda d, i: F.when(
        i % 2 == 1, d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0)).otherwise(d.cast("int")))
    return F.aggregate(doubled, F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0)))


def _draw(seed: Column, i: Column) -> Column:
    """A number from 0 to 65,535 for place i."""
    at = (i * 4) % 124 + 1
    return F.conv(F.substring(seed, at, F.lit(4)), 16, 10).cast("int")


def _chars(text: Column) -> Column:
    return F.filter(F.split(text, ""), lambda c: c != "")


def _masked(text: Column, seed: Column, skip: int = 0) -> Column:
    """Every letter and digit after the first ``skip`` characters drawn anew
    within its class; the first digit of a run is not zero. One walk over the
    characters, each beside the one before it."""
    before = F.concat(F.array(F.lit("")), _chars(text))
    pairs = F.arrays_zip(_chars(text).alias("c"), before.alias("p"))

    def one(x: Column, at: Column) -> Column:
        c, i = x["c"], at + 1
        v = _draw(seed, i)
        run = ~x["p"].rlike(r"\d")
        out = F.when(i <= skip, c).when(c.rlike(r"\d"), F.when(run, 1 + v % 9).otherwise(v % 10).cast("string"))
        for span, letters in _ALPHABETS.items():
            out = out.when(c.rlike(f"[{span}]"), F.lit(letters).substr(v % len(letters) + 1, F.lit(1)))
        return out.when(c.rlike(r"\p{L}"), "x").otherwise(c)

    # ``before`` is one longer: its last pair has no character and joins nothing.
    return F.array_join(F.transform(pairs, one), "")


def _pick(values: tuple[str, ...], n: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), n % len(values) + 1)


def _script(name: Column) -> Column:
    return F.when(name.rlike(r"\p{IsCyrillic}"), "cyrillic").when(name.rlike(r"\p{IsGreek}"), "greek").otherwise("latin")


def _syllables(values: tuple[str, ...], seed: Column, first: int, n: Column) -> Column:
    """n syllables, drawn from place ``first`` on, as one capitalised word."""
    drawn = F.transform(F.sequence(F.lit(first), n + (first - 1)), lambda j: _pick(values, _draw(seed, j)))
    return F.initcap(F.array_join(drawn, ""))


def _seed(key: str) -> Column:
    """What every draw of a row's attempt comes from; kept as a column, so that
    it is hashed once and not for every character."""
    return F.sha2(F.concat_ws("|", F.lit(key), "kind", "norm", F.col("attempt").cast("string")), 512)


def _family(norm: Column, seed: Column, attempt: Column) -> Column:
    """A family name of three syllables, and one more for each attempt."""
    out = F
    for s, syl in SYLLABLES.items():
        out = out.when(_script(norm) == s, _syllables(syl, seed, 1, attempt + 3))
    return out


def _name(norm: Column, gender: Column, key: str, attempt: Column, family: Column) -> Column:
    """Names part by part: the last is ``family``, others given names."""
    parts = F.split(norm, " ")

    def given(p: Column) -> Column:
        seed = F.sha2(F.concat_ws("|", F.lit(key), gender, p, attempt.cast("string")), 512)
        out = F
        for s, syl in SYLLABLES.items():
            one = F.when(gender == "f", _pick(GIVEN[s, "f"], _draw(seed, F.lit(1)))).otherwise(
                _pick(GIVEN[s, "m"], _draw(seed, F.lit(1))))
            # Given names are few: a further attempt adds syllables.
            one = F.when(attempt > 0, F.concat(one, F.lit("-"), _syllables(syl, seed, 2, attempt))).otherwise(one)
            out = out.when(_script(p) == s, one)
        return F.when(F.lower(p).isin(*PARTICLES), F.lower(p)).otherwise(out)

    return F.array_join(F.concat(F.transform(F.slice(parts, F.lit(1), F.size(parts) - 1), given), F.array(family)), " ")


def surrogate(kind: Column, norm: Column, gender: Column, key: str, attempt: Column, family: Column,
              seed: Column) -> Column:
    """The stand-in for a normal form at an attempt number; ``family`` is the
    family name's, for names. From the third attempt on octets leave their
    width; from _IN_SHAPE on a character is added for each."""
    at = F.locate("@", norm)
    tld = F.element_at(F.split(norm, r"\."), -1)
    email = F.concat(_masked(F.substring(norm, F.lit(1), at - 1), seed), F.lit("@mail"),
                     (_draw(seed, F.lit(30)) % 1000).cast("string"), F.lit(".example"),
                     F.when(tld.isin("com", "net", "org"), F.concat(F.lit("."), tld)).otherwise(F.lit("")))
    octets = F.transform(F.split(norm, r"\."), lambda o, i: F.when(attempt > 1, _draw(seed, i) % 256)
                         .when(F.length(o) == 1, 1 + _draw(seed, i) % 9)
                         .when(F.length(o) == 2, 10 + _draw(seed, i) % 90)
                         .otherwise(100 + _draw(seed, i) % 156).cast("string"))
    spare = F.greatest(attempt - _IN_SHAPE, F.lit(0))
    longer = F.array_join(F.transform(F.sequence(F.lit(0), spare), lambda j: F.when(
        j > 0, (_draw(seed, j + 7) % 10).cast("string")).otherwise("")), "")
    six = F.translate(_masked(F.lower(norm), seed), "ghijklmnopqrstuvwxyz", "abcdefabcdefabcdefab")
    open_ = F.concat(_masked(norm.substr(F.lit(1), F.length(norm) - 1), seed, 1), F.lit("0"))
    check = (10 - _luhn(open_) % 10) % 10
    card = F.concat(open_.substr(F.lit(1), F.length(norm) - 1), check.cast("string"))
    code = F.length(F.regexp_extract(norm, r"^\+(\d{1,3}) ", 1))  # norm of a phone: +cc and a space, then digits
    phone = F.concat(norm.substr(F.lit(1), F.when(code > 0, code + 2).otherwise(0)),
                     _masked(norm.substr(F.when(code > 0, code + 3).otherwise(1), F.length(norm)), seed))
    hexed = F.translate(_masked(norm, seed), "ghijklmnopqrstuvwxyz", "abcdefabcdefabcdefab")
    upper_hexed = F.translate(_masked(norm, seed), "GHIJKLMNOPQRSTUVWXYZ", "ABCDEFABCDEFABCDEFAB")
    drawn = (F.when(kind == "email", email).when(kind == "ip", F.array_join(octets, ".")).when(kind == "ipv6", six)
            .when(kind == "card", card).when(kind == "phone", F.regexp_replace(phone, "^\\+(\\d+) ", "+$1 "))
            .when(kind == "iban", _masked(norm, seed, 2)).when(kind == "access", _masked(norm, seed, 4))
            .when(norm.rlike("^[0-9a-f]{8,}$"), hexed)
            .when(norm.rlike("^[0-9A-F]{8,}$"), upper_hexed).when(kind == "name", _name(norm, gender, key, attempt, family))
            .otherwise(_masked(norm, seed)))
    # Names grow by themselves; an address takes the digits in front.
    return (F.when(kind == "name", drawn).when(kind == "email", F.concat(longer, drawn))
            .when((kind == "ip") & (spare > 0), F.concat(drawn, F.lit("."), longer)).otherwise(F.concat(drawn, longer)))


def _norm(kind: Column, entity: Column) -> Column:
    plain = F.regexp_replace(entity, r"[^\p{L}\p{N}]", "")
    code = F.regexp_extract(entity, r"^\+(\d{1,3})[^\d]", 1)
    phone = F.when(code != "", F.concat(F.lit("+"), code, F.lit(" "), plain.substr(F.length(code) + 1, F.length(plain)))).otherwise(plain)
    return (F.when(kind == "email", F.lower(entity)).when(kind == "phone", phone)
            .when(kind.isin("ssn", "iban", "card"), plain).when(kind == "ipv6", F.lower(entity))
            .when(kind == "name", F.initcap(entity)).otherwise(entity))


def _poured(kind: Column, entity: Column, core: Column) -> Column:
    """The surrogate in the occurrence's own format."""
    digits = F.regexp_replace(core, r"[^\p{L}\p{N}]", "")

    def one(i: Column) -> Column:
        c = entity.substr(i, F.lit(1))
        k = F.length(F.regexp_replace(entity.substr(F.lit(1), i), r"[^\p{L}\p{N}]", ""))
        return F.when(c.rlike(r"[\p{L}\p{N}]"), digits.substr(k, F.lit(1))).otherwise(c)

    into = F.array_join(F.transform(F.sequence(F.lit(1), F.length(entity)), one), "")
    filled = F.length(F.regexp_replace(entity, r"[^\p{L}\p{N}]", ""))
    into = F.concat(into, digits.substr(filled + 1, F.greatest(F.length(digits) - filled, F.lit(0))))
    return (F.when(kind.isin(*_POURED), into)
            .when((kind == "name") & (F.upper(entity) == entity), F.upper(core)).otherwise(core))


def entities(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(hits, rest): documents with a match, taken apart and written once, with
    ``_doc`` (its columns), ``_row``, ``_between`` (text around matches) and ``_found`` (place, kind,
    entity, norm, gender); and the other documents as they are."""
    has = F.when(F.col("text").rlike(HINT), F.col("text").rlike(PATTERN)).otherwise(F.lit(False))
    pattern = F.lit(PATTERN)
    # The document's own columns lie in a struct: none clashes with a helper.
    hits = docs.where(has).select(
        F.struct(*docs.columns).alias("_doc"), F.monotonically_increasing_id().alias("_row"),
        F.split("text", PATTERN, -1).alias("_between"),
        F.regexp_extract_all("text", pattern, F.lit(0)).alias("_match"))
    women = "|".join(ADDRESS["f"])

    def found(e: Column, i: Column) -> Column:
        lead = F.regexp_extract(e, LEAD, 0)
        gender = F.when(lead.rlike(rf"^(?:{women})\b"), "f").otherwise("m")
        return F.struct(i.alias("at"), e.alias("entity"), lead.alias("lead"), gender.alias("gender"))

    hits = hits.withColumn("_found", F.transform("_match", found)).drop("_match")
    return stage(hits, "pii-hits"), docs.where(~has)


def _settled(known: DataFrame, real: DataFrame, drawn: Column, key: str) -> DataFrame:
    """known with ``core``: ``drawn`` at the first attempt that clashes neither
    with another row's nor with a real entity (``real``: core)."""
    attempt = 0
    table = stage(known.withColumn("attempt", F.lit(0)).withColumn("_seed", _seed(key))
                  .withColumn("core", drawn).drop("_seed"), "pii-surrogates")
    while True:
        # Of those that drew one surrogate, the earliest attempt and first
        # entity keeps it; it must not be anyone's real value either.
        first = table.groupBy("core").agg(F.min(F.struct("attempt", "kind", "norm")).alias("keeper"), F.count("*").alias("n"))
        lost = table.join(first.where("n > 1"), "core").where(F.struct("attempt", "kind", "norm") != F.col("keeper"))
        clash = stage(lost.select("kind", "norm").unionByName(
            table.join(real, "core", "left_semi").select("kind", "norm")).distinct(), "pii-clashes")
        if clash.isEmpty():
            return table.drop("attempt")
        attempt += 1
        again = table.join(clash, ["kind", "norm"], "left_semi").drop("core").withColumn(
            "attempt", F.lit(attempt)).withColumn("_seed", _seed(key)).withColumn("core", drawn).drop("_seed")
        table = stage(table.join(clash, ["kind", "norm"], "left_anti").unionByName(again), "pii-surrogates")


def surrogate_table(found: DataFrame, key: str) -> DataFrame:
    """kind, norm, gender, core: one row per distinct entity, surrogates
    distinct from each other and from every real entity."""
    known = stage(found.where("kind is not null").groupBy("kind", "norm").agg(F.min("gender").alias("gender")), "pii-entities")
    names = known.where("kind = 'name'").withColumn("family", F.element_at(F.split("norm", " "), -1))
    families = names.select(F.lit("family").alias("kind"), F.col("family").alias("norm")).distinct()
    real = known.unionByName(families, allowMissingColumns=True).select(F.col("norm").alias("core")).distinct()
    heads = _settled(families, real, _family(F.col("norm"), F.col("_seed"), F.col("attempt")), key)
    named = names.join(heads.select(F.col("norm").alias("family"), F.col("core").alias("head")), "family").drop("family")
    # A name of one part is its family name, which is settled: of a surrogate
    # drawn twice, names ("name" < "secret") keep theirs.
    known = named.unionByName(known.where("kind <> 'name'"), allowMissingColumns=True)
    return _settled(known, real, surrogate(
        F.col("kind"), F.col("norm"), F.col("gender"), key, F.col("attempt"), F.col("head"), F.col("_seed")),
        key).drop("head")


def replace_entities(docs: DataFrame, key: str = "surrogates") -> DataFrame:
    """docs with every entity in ``text`` replaced, plus ``entities`` (array of
    struct<at, kind, surrogate>, empty for other documents)."""
    hits, rest = entities(docs)
    found = hits.select("_row", F.explode("_found").alias("f")).select("_row", "f.*")
    found = found.withColumn("kind", _kind(F.col("entity"))).withColumn(
        "entity", F.col("entity").substr(F.length("lead") + 1, F.length("entity")))
    found = stage(found.withColumn("norm", _norm(F.col("kind"), F.col("entity"))), "pii-found")
    table = surrogate_table(found, key)
    core = found.join(table.drop("gender"), ["kind", "norm"])
    done = core.groupBy("_row").agg(F.sort_array(F.collect_list(F.struct(
        "at", "kind", F.concat("lead", _poured(F.col("kind"), F.col("entity"), F.col("core"))).alias("surrogate")))).alias("_done"))
    joined = hits.join(done, "_row", "left")
    by_place = F.map_from_entries(F.transform(F.coalesce("_done", F.array()), lambda d: F.struct(d["at"], d["surrogate"])))
    filled = F.transform("_found", lambda f: F.coalesce(F.element_at(F.col("_by"), f["at"]), f["entity"]))
    text = F.array_join(F.flatten(F.zip_with("_between", F.col("_filled"), lambda a, b: F.array(
        F.coalesce(a, F.lit("")), F.coalesce(b, F.lit(""))))), "")
    kept = [c for c in docs.columns if c != "entities"]
    none = F.array().cast("array<struct<at:int,kind:string,surrogate:string>>")
    out = joined.withColumn("_by", by_place).withColumn("_filled", filled).select(
        "_doc", text.alias("_new"), F.coalesce(F.col("_done"), none).alias("entities"))
    new = {c: F.col("_doc").getField(c) for c in kept} | {"text": F.col("_new")}
    if "n_chars" in kept:
        new["n_chars"] = F.length("_new").cast(docs.schema["n_chars"].dataType)
    out = out.select(*(v.alias(c) for c, v in new.items()), "entities")
    return out.unionByName(rest.select(*kept).withColumn("entities", none))
