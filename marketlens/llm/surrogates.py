"""PII: surrogate generation, in DataFrame functions only.

Detection: e-mail addresses, phone numbers, payment cards (Luhn-valid),
IPv4 addresses, 3-2-4 social security numbers, and persons (an honorific or a
known given name before a capitalised name).  One regular expression cuts a
text into gaps and entities; the rewritten text is the same gaps with
surrogates between them.

Surrogates are keyed hashes of the normalised entity, of its own type and
format: digits go into the punctuation of each occurrence, cards stay
Luhn-valid and keep their first digit, phones keep the digits before the last
ten, addresses keep their top-level domain, given names keep gender and
script, surnames script and gendered ending, letters keep upper or title
case.  A person's given name and surname are replaced on their own, so "John
Smith" and "Mr Smith" still name one person.

Collision checks: over the whole corpus, a surrogate is accepted only if no
other entity of its type has it and it equals no original of that type; of
several claimants the smallest keeps it, the others hash again (with longer
forms after a few attempts, so that the rounds end).  So the mapping is one to
one per type (distinctness) and a function of the entity (coreference); it
depends on the key and the set of entities alone.

Rows meet their surrogates by their number in a written copy: no text is
shuffled, and equal lists of entities are handled once.  Null and empty texts and texts without
entities come back unchanged; null ids pass through; repeated rows repeat;
other columns are kept (``n_<kind>`` and the text are replaced).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from marketlens.llm.common import fresh_names, numbered
from marketlens.session import materialize

KEY = "surrogate-key-1"  # callers pass their own secret

#: Fixed word lists: honorifics by gender, given names by gender and script.
HONORIFICS = {
    "m": ("Mr", "Sir", "Herr", "Señor", "Monsieur", "Господин", "Κύριος"),
    "f": ("Mrs", "Ms", "Miss", "Frau", "Señora", "Madame", "Госпожа", "Κυρία"),
}
GIVEN = {
    ("m", "latin"): ("James", "John", "Robert", "Michael", "William", "David", "Peter", "Thomas",
                     "Hans", "Karl", "Pierre", "Jean", "Carlos", "José", "Juan", "Luis"),
    ("f", "latin"): ("Mary", "Patricia", "Jennifer", "Linda", "Elizabeth", "Anna", "Susan", "Sarah",
                     "Claire", "Sophie", "Carmen", "Lucía", "Greta", "Ingrid", "Marie", "Helga"),
    ("m", "cyrillic"): ("Иван", "Пётр", "Сергей", "Алексей", "Дмитрий", "Николай"),
    ("f", "cyrillic"): ("Анна", "Мария", "Ольга", "Елена", "Татьяна", "Наталья"),
    ("m", "greek"): ("Γιώργος", "Νίκος", "Κώστας", "Δημήτρης"),
    ("f", "greek"): ("Μαρία", "Ελένη", "Κατερίνα", "Σοφία"),
}
_SYLLABLES = {
    "latin": ("bar", "ben", "cor", "dal", "den", "far", "gar", "hol", "kel", "lan", "mar", "nor", "ral", "sten", "tor", "wal"),
    "cyrillic": ("бар", "вол", "гор", "дем", "зор", "кар", "лав", "мир", "нов", "пол", "рад", "сам", "тар", "фад", "хол", "чер"),
    "greek": ("βαρ", "γαλ", "δαν", "ζαχ", "θεο", "καρ", "λαμ", "μαν", "νικ", "παπ", "ραλ", "σαρ", "ταν", "φιλ", "χατ", "ψαρ"),
}
_ENDINGS = {"latin": ("er",), "cyrillic": ("ов", "ова"), "greek": ("ης",)}

_NAME = r"\p{Lu}[\p{L}'’-]{1,30}"
_EDGE = r"(?<![\p{L}\p{N}])"
_HON = "|".join(h for hs in HONORIFICS.values() for h in hs)
_GIV = "|".join(g for gs in GIVEN.values() for g in gs)
_OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
_IP = rf"{_OCTET}(?:\.{_OCTET}){{3}}"
_WORD = r"\p{L}\p{M}\p{N}_"  # \w knows ASCII only
_LABEL = r"\p{L}\p{M}\p{N}-"
PATTERN = "|".join((
    rf"(?<![{_WORD}.%+-])[{_WORD}][{_WORD}.%+-]{{0,63}}@[{_LABEL}]{{1,63}}(?:\.[{_LABEL}]{{1,63}}){{0,5}}\.[A-Za-z]{{2,24}}",
    rf"(?<![\w.]){_IP}(?!\w)(?!\.\d)",
    r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])",
    r"(?<![\w.-])(?:\d{13,19}|\d{4}[ -]\d{4}[ -]\d{4}[ -]\d{1,7})(?![\w-])",
    r"(?<![\w+])(?:\+\d{1,3}[ .-]?)?\(\d{2,4}\)[ .-]?\d{3,4}[ .-]?\d{3,4}(?!\d)",
    r"(?<![\w+])\+\d{1,3}(?:[ .-]?\d{2,4}){2,4}(?!\d)",
    r"(?<![\w.-])(?:1[ .-])?\d{3}[.-]\d{3}[.-]\d{4}(?![\w-])",
    # national numbers in spaces or none, and with a trunk prefix
    r"(?<![\w.+-])(?:1[ .-]?)?[2-9]\d{2}(?: \d{3}[ .-]|\d{3})\d{4}(?![\w-])(?!\.\d)",
    r"(?<![\w.+-])0[1-9](?:\d{1,2}[ /-]\d{3,4}[ -]?\d{3,4}|\d{3}[ /-]\d{3}[ -]?\d{3,4}|(?:[ .-]\d{2}){4}|\d{8,10})(?![\w-])(?!\.\d)",
    rf"{_EDGE}(?:{_HON})\.? (?:{_NAME} )?{_NAME}",
    rf"{_EDGE}(?:{_GIV}) {_NAME}",
))
_PERSON = rf"^((?:(?:{_HON})\.? )?)((?:{_NAME} )?)({_NAME})$"
KINDS = ("email", "phone", "card", "ip", "ssn", "person")
LONGER_AFTER = 12  # attempts before digit formats grow


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, r"\D", "")


def _luhn_sum(digits: Column, first_doubled: int) -> Column:
    """Luhn sum; counted from the right, digits at odd (first_doubled = 1) or
    even (0) places are doubled."""
    d = F.transform(F.split(F.reverse(digits), ""), lambda c, i: F.when(
        i % 2 == first_doubled, F.expr("0") + c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0)
    ).otherwise(c.cast("int")))
    return F.aggregate(d, F.lit(0), lambda a, x: a + x)


def kind_of(e: Column) -> Column:
    """Entity kind, or null for a match that is no entity (a number that
    fails the Luhn check)."""
    bare = F.regexp_replace(e, "[ -]", "")
    return (F.when(e.contains("@"), "email")
            .when(e.rlike(r"^\p{L}"), "person")
            .when(e.rlike(rf"^{_IP}$"), "ip")
            .when(e.rlike(r"^\d{3}-\d{2}-\d{4}$"), "ssn")
            .when(bare.rlike(r"^\d{13,19}$") & ~e.startswith("+"),
                  F.when(_luhn_sum(bare, 1) % 10 == 0, "card"))
            .otherwise("phone"))


def _script(s: Column) -> Column:
    return F.when(s.rlike(r"\p{IsCyrillic}"), "cyrillic").when(s.rlike(r"\p{IsGreek}"), "greek").otherwise("latin")


def _parts(e: Column) -> Column:
    """An entity as an ordered array of (kind, raw, norm); literal parts have
    a null kind."""
    kind = kind_of(e)
    part = lambda k, raw, norm: F.struct(k.cast("string").alias("kind"), raw.alias("raw"), norm.alias("norm"))
    hon, given, sur = (F.regexp_extract(e, _PERSON, i) for i in (1, 2, 3))
    name = F.trim(given)
    honored = F.regexp_replace(hon, r"[. ]", "")
    gender = F.when(honored.isin(*HONORIFICS["m"]), "m").when(honored.isin(*HONORIFICS["f"]), "f")
    for (g, _), names in GIVEN.items():
        gender = F.coalesce(gender, F.when(name.isin(*names), g))
    # a name that follows a known given name is a surname; "Mr X" has only a surname
    given_kind = F.when(given != "", F.concat_ws(":", F.lit("given"), F.coalesce(gender, F.lit("u")), _script(name)))
    gendered = F.when((_script(sur) == "cyrillic") & sur.rlike("а$"), "f").otherwise("m")
    person = F.array(
        part(F.lit(None), hon, hon),
        part(given_kind, name, F.lower(name)),
        part(F.lit(None), F.when(given != "", F.lit(" ")).otherwise(F.lit("")), F.lit("")),
        part(F.concat_ws(":", F.lit("surname"), gendered, _script(sur)), sur, F.lower(sur)))
    plain = F.array(part(kind, e, F.when(kind == "email", F.lower(e)).when(kind == "ip", e).otherwise(_digits(e))))
    return F.when(kind == "person", person).otherwise(plain)


def _hash(key: str, attempt: int, salt: str) -> Column:
    """Keyed hash of (kind, norm): the key is hashed in twice, inner and outer."""
    inner = F.sha2(F.concat_ws("|", F.lit(f"in:{key}"), "kind", "norm", F.lit(f"{attempt}:{salt}")), 256)
    return F.sha2(F.concat(F.lit(f"out:{key}|"), inner), 256)


def _number(h: Column, start: int = 1) -> Column:
    return F.conv(F.substring(h, start, 12), 16, 10).cast("long")


def _pick(words, h: Column, start: int) -> Column:
    return F.element_at(F.array(*map(F.lit, words)), (_number(h, start) % len(words) + 1).cast("int"))


def candidate(key: str, attempt: int) -> Column:
    """Surrogate of (kind, norm) at an attempt, in normalised form."""
    h, more = _hash(key, attempt, "a"), max(0, attempt - LONGER_AFTER)
    run = F.concat(*[F.lpad((_number(_hash(key, attempt, f"d{i}")) % 10**12).cast("string"), 12, "0")
                     for i in range(2 + -(-2 * more // 12))])
    n = F.length("norm")
    kept = F.greatest(n - 10, F.lit(0))
    phone = F.concat(F.substring("norm", F.lit(1), kept), (_number(h, 13) % 8 + 2).cast("string"),
                     F.substring(run, F.lit(1), n - kept - 1 + 2 * more))
    body = F.concat(F.substring("norm", 1, 1), F.substring(run, F.lit(1), n - 2 + 2 * more))
    card = F.concat(body, ((10 - _luhn_sum(body, 0) % 10) % 10).cast("string"))
    ssn = F.concat(F.lit("9"), F.substring(run, 1, 8 + 2 * more))
    octets = [(_number(h, 1 + 12 * i) % 254 + 1).cast("string") for i in range(4)]
    ip = F.concat_ws(".", *octets) if not more else F.concat(
        F.lit("2001:db8:"), *[F.concat(F.lit(":"), F.substring(h, 1 + 4 * i, 4)) for i in range(4)])
    extra = [_pick(_SYLLABLES["latin"], _hash(key, attempt, f"e{i}"), 1) for i in range(attempt)]
    email = F.concat(*[_pick(_SYLLABLES["latin"], h, s) for s in (1, 13, 25)], *extra, F.lit("."),
                     F.lpad((_number(h, 37) % 100).cast("string"), 2, "0"), F.lit("@"),
                     *[_pick(_SYLLABLES["latin"], h, s) for s in (45, 52)], F.lit(".example."),
                     F.regexp_extract("norm", r"\.([a-z]+)$", 1))
    out = (F.when(F.col("kind") == "phone", phone).when(F.col("kind") == "card", card)
           .when(F.col("kind") == "ssn", ssn).when(F.col("kind") == "ip", ip).when(F.col("kind") == "email", email))
    for script, syllables in _SYLLABLES.items():
        longer = [_pick(syllables, _hash(key, attempt, f"s{i}"), 1) for i in range(attempt)]
        for g, end in zip(("m", "f"), _ENDINGS[script] * 2):
            name = F.concat(*[_pick(syllables, h, s) for s in (1, 13, 25)], *longer, F.lit(end))
            out = out.when(F.col("kind") == f"surname:{g}:{script}", name)
        for g in ("m", "f", "u"):
            pool = [x.lower() for (gg, ss), xs in GIVEN.items() if ss == script and g in (gg, "u") for x in xs]
            first = _pick(pool, h, 1)
            second = [F.concat(F.lit("-"), _pick(pool, _hash(key, attempt, f"g{i}"), 1)) for i in range(attempt)]
            out = out.when(F.col("kind") == f"given:{g}:{script}", F.concat(first, *second))
    return out


def surrogate_map(units: DataFrame, key: str = KEY) -> DataFrame:
    """(kind, norm) -> with ``sur``, one to one per kind."""
    pending = materialize(units.select("kind", "norm").distinct(), "pii-units")
    originals, accepted, attempt = pending.withColumnRenamed("norm", "sur"), None, 0
    while not pending.isEmpty():
        claims = pending.withColumn("sur", candidate(key, attempt))
        won = claims.groupBy("kind", "sur").agg(F.min("norm").alias("norm"))
        won = won.join(originals, ["kind", "sur"], "left_anti")
        if accepted is not None:
            won = won.join(accepted, ["kind", "sur"], "left_anti")
        won = materialize(won.select("kind", "norm", "sur"), "pii-won")
        accepted = won if accepted is None else accepted.union(won)
        pending = materialize(pending.join(won, ["kind", "norm"], "left_anti"), "pii-left")
        attempt += 1
    return accepted if accepted is not None else pending.withColumn("sur", F.col("norm"))


def _laid_out(kind: Column, raw: Column, sur: Column) -> Column:
    """A surrogate in the format of one occurrence."""
    chars = F.aggregate(
        F.split(raw, ""), F.struct(F.lit("").alias("s"), F.lit(1).alias("i")),
        lambda a, c: F.when(c.rlike(r"\d"), F.struct(F.concat(a["s"], F.substring(sur, a["i"], F.lit(1))).alias("s"),
                                                    (a["i"] + 1).alias("i")))
        .otherwise(F.struct(F.concat(a["s"], c).alias("s"), a["i"].alias("i"))),
        lambda a: F.concat(a["s"], F.substring(sur, a["i"], F.length(sur))))
    named = F.when((raw == F.upper(raw)) & (F.length(raw) > 1), F.upper(sur)).otherwise(F.initcap(sur))
    named = F.when(raw.contains("-") | ~sur.contains("-"), named).otherwise(
        F.array_join(F.transform(F.split(sur, "-"), F.initcap), "-"))
    return (F.when(kind.isin("email", "ip"), sur).when(kind.isin("phone", "card", "ssn"), chars).otherwise(named))


def replace_pii(df: DataFrame, key: str = KEY, text_col: str = "text") -> DataFrame:
    """``df`` with surrogates in its texts and counts n_email, n_phone,
    n_card, n_ip, n_ssn, n_person (columns of these names are replaced, all
    others come back whatever their names).  Null and empty texts stay as
    they are.

    The pattern runs over every text once, into a numbered copy of the table;
    rows with entities meet their surrogates there, so no text is shuffled
    and only texts with entities are cut at the pattern."""
    df = df.drop(*[f"n_{k}" for k in KINDS])
    ents, outs = fresh_names(df, "ents", "outs")
    copy = numbered(df.withColumn(ents, F.regexp_extract_all(text_col, F.lit(PATTERN), F.lit(0))), "pii-rows")
    # equal lists of entities (copies of a text) are treated once; no entity holds a control character
    found = (copy.select(F.md5(F.array_join(ents, "\x01").cast("binary")).alias("_key"), F.col(ents).alias("ents"))
             .where(F.size("ents") > 0))
    lists = materialize(found.groupBy("_key").agg(F.min("ents").alias("ents")), "pii-texts")
    parts = (lists.select("_key", F.posexplode("ents").alias("k", "e"))
             .select("_key", "k", kind_of(F.col("e")).alias("entity"), F.posexplode(_parts(F.col("e"))).alias("i", "p"))
             .select("_key", "k", "entity", "i", "p.*"))
    parts = materialize(parts, "pii-parts")
    known = materialize(surrogate_map(parts.where("kind is not null"), key), "pii-map")
    laid = (parts.where("kind is not null").join(known, ["kind", "norm"])
            .select("_key", "k", "entity", "i", _laid_out(F.col("kind"), F.col("raw"), F.col("sur")).alias("out")))
    laid = laid.union(parts.where("kind is null").select("_key", "k", "entity", "i", F.col("raw").alias("out")))
    whole = laid.groupBy("_key", "k", "entity").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", "out"))), lambda s: s["out"]), "").alias("out"))
    made = whole.groupBy("_key").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("k", "out"))), lambda s: s["out"]).alias(outs),
        *[F.sum((F.col("entity") == k).cast("long")).alias(f"n_{k}") for k in KINDS])
    made = materialize(made, "pii-made")
    decided = found.select("row", "_key").join(made, "_key").drop("_key")
    gaps = F.split(F.col(text_col), PATTERN, -1)
    rebuilt = F.array_join(F.zip_with(gaps, F.concat(F.col(outs), F.array(F.lit(""))), lambda g, o: F.concat(g, o)), "")
    text = F.when(F.col(outs).isNull(), F.col(text_col)).otherwise(rebuilt)
    return copy.join(decided, "left").select(
        *[c for c in df.columns if c != text_col], text.alias(text_col),
        *[F.coalesce(f"n_{k}", F.lit(0)).cast("long").alias(f"n_{k}") for k in KINDS])
