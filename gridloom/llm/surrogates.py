"""Surrogates for personal data; DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridloom.llm._shared import free, materialize

EMAIL = r"[\p{L}\p{N}._%+-]{1,64}+@[\p{L}\p{N}-]{1,63}(?:\.[\p{L}\p{N}-]{1,63}){1,6}"
IP = r"(?<![\d.])(?<![vV])(?<![vV]ersion )(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\d.]*\d)"
CARD = r"(?<!\d)\d(?:[ -]?\d){12,18}(?!\d)"
PHONE = r"(?<![\d(])(?:\+\d{1,3}[ .-]?)?\(\d{2,4}\)[ .-]?\d{3,4}[ .-]?\d{3,4}(?!\d)|(?<!\d)\+\d{1,3}(?:[ .-]?\d){7,12}(?!\d)|(?<![\d.-])(?<!\d )\d{3}[ .-]\d{3}[ .-]\d{4}(?![ .-]?\d)|(?<![\d.-])(?<!\d )(?<![vV]ersion )(?=0(?:[ /-]?\d){8})0\d{1,4}[ /-]\d{3,8}(?:[ -]\d{2,4}){0,2}(?![ .-]?\d)"
#: Social security numbers, and IPv6 addresses with eight groups or with ::.
SSN = r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"
IP6 = r"(?<![\w:.])(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}|(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,5})?::(?:[0-9A-Fa-f]{1,4}:){0,5}[0-9A-Fa-f]{1,4}|[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){1,6}::(?!:))(?![\w:.]*\w)"
#: International bank account numbers, whole or in groups of four.
IBAN = r"(?<!\w)[A-Z]{2}\d{2}(?: ?[0-9A-Z]{4}){2,7}(?: ?[0-9A-Z]{1,3})?(?!\w)"
MALE_TITLES, FEMALE_TITLES = ("Mr", "Herr", "Señor", "Sr", "Monsieur"), ("Mrs", "Ms", "Miss", "Frau", "Señora", "Sra", "Madame", "Mme")
#: Given names (fixed values) by gender; a name behind a title or of these lists is a person's.
MALE = ("James", "John", "Robert", "Michael", "William", "David", "Thomas", "Peter", "Paul", "Hans", "Karl", "Pierre", "Jean", "Carlos", "Juan", "Luis", "Miguel", "Klaus", "Stefan", "Henri")
FEMALE = ("Mary", "Anna", "Linda", "Susan", "Sarah", "Emma", "Laura", "Julia", "Maria", "Claire", "Sophie", "Ingrid", "Petra", "Elena", "Carmen", "Lucia", "Alice", "Helga", "Monique", "Rosa")
#: Cyrillic ones.
MALE_CYRILLIC, FEMALE_CYRILLIC = ("Иван", "Пётр", "Сергей", "Олег", "Борис", "Павел"), ("Анна", "Мария", "Ольга", "Елена", "Нина", "Вера")
SYLLABLES = ("ba", "den", "fal", "gor", "hin", "kel", "lum", "mor", "nes", "pol", "ras", "sten", "tor", "ul", "ven", "wick", "yar", "zel", "bro", "cran", "dal", "esk", "fen", "grim", "holt", "ing", "jor", "kam", "lin", "marsh", "nor", "oak")
SYLLABLES_CYRILLIC = ("ба", "вол", "гор", "дин", "жар", "зим", "кал", "лев", "мор", "нов", "пет", "рос", "сав", "тих", "чер", "шум")
_TITLE = "|".join((*MALE_TITLES, *FEMALE_TITLES, "Dr", "Prof"))
_GIVEN = "|".join((*MALE, *FEMALE, *MALE_CYRILLIC, *FEMALE_CYRILLIC))
#: A capitalised part of a name: O'Brien, McDonald, Smith-Jones, Wu; initials and small words may stand before one.
PART = r"\p{Lu}(?:\p{L}|['’](?=\p{Lu})|-(?=\p{L}))++"
_MORE = rf"(?: (?:\p{{Lu}}\. ?){{0,3}}(?:(?:van|von|der|den|de|da|di|del|du|la|le|bin|ibn|al|el|zu|zur) ){{0,3}}{PART})"
NAME = rf"(?=\p{{Lu}})(?<!\p{{L}})(?:(?:{_TITLE})\.?{_MORE}{{1,4}}|(?:{_GIVEN})(?!\p{{L}}){_MORE}{{1,4}})"
_MR, _MRS = "Mr ", "Mrs "  # before an entity whose title alone tells the gender
#: Looking ahead for a digit, sign or capital spares most positions of a text the other tries.
NO_EMAIL = rf"(?=[\d+(])(?:{SSN}|{PHONE}|{CARD}|{IP})|(?=[0-9A-Fa-f]{{0,4}}:[0-9A-Fa-f:])(?:{IP6})|(?=[A-Z]{{2}}\d)(?:{IBAN})|(?:{NAME})"
ANY = f"(?:{EMAIL})|{NO_EMAIL}"
#: Rounds in which a surrogate keeps its entity's format; later ones get longer, so that there is always a free one.
ROUNDS = 8
_LOWER, _UPPER, _ACCENTS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "àâäçéèêëíîïñóôöúûü"
_GREEK, _CYRILLIC, _HAN = "αβγδεζηθικλμνξοπρστυφχψω", "абвгдежзиклмнопрстуфхцчшэюя", "山川田中木林森石水火土金日月風雲花草竹松"


def kind_of(m: Column) -> Column:
    digits = F.length(F.regexp_replace(m, r"\D", ""))
    return F.when(m.contains("@"), "email").when(m.rlike(f"^(?:{IP})$"), "ip").when(m.rlike(f"^(?:{IP6})$"), "ip6").when(m.rlike(f"^(?:{SSN})$"), "ssn").when(m.rlike(f"^(?:{IBAN})$"), "iban").when(m.rlike(r"^\d[\d -]*$") & (digits >= 13), "card").when(m.rlike(r"\d"), "phone").otherwise("name")


def _luhn(digits: Column) -> Column:
    """The sum that a card number's check digit makes a multiple of ten."""
    turned = F.transform(F.reverse(F.split(digits, "")), lambda c: c.cast("int"))
    return F.aggregate(F.transform(turned, lambda d, i: F.when(i % 2 == 0, d).when(d > 4, d * 2 - 9).otherwise(d * 2)), F.lit(0), lambda a, d: a + d)


def _mod97(account: Column) -> Column:
    """An account number, its country and check digits behind it, modulo 97; a letter counts as two digits."""
    turned = F.concat(F.substring(account, 5, 40), F.substring(account, 1, 4))
    value = lambda c: F.when(c.rlike(r"\d"), F.ascii(c) - 48).otherwise(F.ascii(c) - 55)
    return F.aggregate(F.split(turned, ""), F.lit(0), lambda a, c: F.pmod(F.when(c.rlike(r"\d"), a * 10).otherwise(a * 100) + value(c), F.lit(97)).cast("int"))


def valid(kind: Column, m: Column) -> Column:
    """Whether a mention is what its form says: cards and accounts by their check digits, so that book numbers, timestamps and
    order numbers stay; an IPv6 address has a digit, so that names with :: in programs stay."""
    return F.when(kind == "card", _luhn(F.regexp_replace(m, r"\D", "")) % 10 == 0).when(kind == "iban", _mod97(F.regexp_replace(m, " ", "")) == 1).when(kind == "ip6", m.rlike(r"\d")).otherwise(F.lit(True))


def _groups(m: Column) -> Column:
    """The eight groups of an IPv6 address, without leading zeros."""
    cut = lambda c: F.filter(F.split(c, ":"), lambda g: g != "")
    low = F.lower(m)
    left, right = cut(F.substring_index(low, "::", 1)), cut(F.when(low.contains("::"), F.substring_index(low, "::", -1)).otherwise(F.lit("")))
    whole = F.concat(left, F.array_repeat(F.lit("0"), F.greatest(F.lit(8) - F.size(left) - F.size(right), F.lit(0))), right)
    return F.transform(whole, lambda g: F.regexp_replace(g, "^0+(?=.)", ""))


def canonical(kind: Column, m: Column) -> Column:
    """What all mentions of an entity have in common."""
    bare = F.regexp_replace(m, rf"^(?:{_TITLE})\.? ", "")
    title, given = F.regexp_extract(m, rf"^({_TITLE})\.? ", 1), F.substring_index(bare, " ", 1)
    name = F.when(given.isin(*MALE, *FEMALE, *MALE_CYRILLIC, *FEMALE_CYRILLIC) & (given != bare), bare).when(title.isin(*MALE_TITLES), F.concat(F.lit(_MR), bare)).when(title.isin(*FEMALE_TITLES), F.concat(F.lit(_MRS), bare)).otherwise(bare)
    digits = F.regexp_replace(m, r"\D", "")
    # a number of the North American plan is the same with and without its country code
    national = F.when(m.startswith("+1") & (F.length(digits) == 11), F.substring(digits, 2, 10)).otherwise(digits)
    return F.when(kind == "phone", national).when(kind.isin("card", "ssn"), digits).when(kind == "iban", F.regexp_replace(m, " ", "")).when(kind == "ip", m).when(kind == "ip6", F.array_join(_groups(m), ":")).when(kind == "email", F.lower(m)).otherwise(name)


def _bare(entity: Column) -> Column:
    return F.regexp_replace(entity, f"^(?:{_MR}|{_MRS})", "")


def linked(mentions: DataFrame, text: str) -> DataFrame:
    """``mentions`` (text's key, mention, kind, entity) in which a surname, or a name of unknown gender, has the entity of
    the one full name of its text that it fits: of the same surname (or name) and no other gender."""
    given = F.substring_index(_bare(F.col("entity")), " ", 1)
    gender = F.when(F.col("entity").startswith(_MR) | given.isin(*MALE, *MALE_CYRILLIC), "m").when(F.col("entity").startswith(_MRS) | given.isin(*FEMALE, *FEMALE_CYRILLIC), "f")
    names = mentions.where("kind = 'name'").withColumn("bare", _bare(F.col("entity"))).withColumn("family", F.substring_index("bare", " ", -1)).withColumn("gender", F.when(F.col("bare").contains(" ") | F.col("entity").startswith(_MR) | F.col("entity").startswith(_MRS), gender))
    full = names.where(F.col("bare").contains(" ")).select(text, "family", F.col("entity").alias("to"), F.col("bare").alias("to_bare"), F.col("gender").alias("to_gender")).distinct()
    alone, other = ~F.col("bare").contains(" "), F.col("gender") != F.col("to_gender")
    fits = F.when(alone, ~F.coalesce(other, F.lit(False))).otherwise(F.col("gender").isNull() & F.col("to_gender").isNotNull() & (F.col("bare") == F.col("to_bare")))
    # a name of unknown gender is no candidate where the same name has one
    told = F.max(F.when(F.col("to_gender").isNotNull(), F.lit(1))).over(Window.partitionBy(text, "mention", "to_bare"))
    pairs = names.join(full, [text, "family"]).where(fits).withColumn("told", told).where("to_gender is not null or told is null")
    one = pairs.groupBy(text, "mention").agg(F.min("to").alias("to"), F.max("to").alias("last")).where("to = last").drop("last")
    return mentions.join(one, [text, "mention"], "left").withColumn("entity", F.coalesce("to", "entity")).drop("to")


def _pick(values: tuple[str, ...] | str, h: Column) -> Column:
    values = tuple(values)
    return F.get(F.array(*map(F.lit, values)), F.pmod(h, F.lit(len(values))).cast("int"))


def _letters(text: Column, seed: Column) -> Column:
    """Each letter or digit replaced by one of its script and case; other characters stay."""
    def one(c: Column, i: Column) -> Column:
        h = F.xxhash64(seed, i)
        return (
            F.when(c.rlike(r"\d"), F.pmod(h, F.lit(10)).cast("string")).when(c.rlike("[a-z]"), _pick(_LOWER, h)).when(c.rlike("[A-Z]"), _pick(_UPPER, h))
            .when(c.rlike(r"\p{IsCyrillic}"), F.when(c.rlike(r"\p{Lu}"), F.upper(_pick(_CYRILLIC, h))).otherwise(_pick(_CYRILLIC, h))).when(c.rlike(r"\p{IsGreek}"), _pick(_GREEK, h))
            .when(c.rlike(r"\p{IsHan}"), _pick(_HAN, h)).when(c.rlike(r"\p{L}"), _pick(_ACCENTS, h)).otherwise(c)
        )

    return F.array_join(F.transform(F.split(text, ""), one), "")


def surrogate(kind: Column, entity: Column, key: str, attempt: int) -> Column:
    """The entity's ``attempt``-th surrogate in canonical form, of its type and format, from a keyed hash."""
    # a keyed SHA-256: without the key no surrogate can be recomputed from a guess
    keyed = F.sha2(F.concat(F.lit(f"{len(key)}:{key}:{attempt}:"), kind, F.lit(":"), entity), 256)
    seed = F.xxhash64(F.conv(F.substring(keyed, 1, 15), 16, 10).cast("long"), F.conv(F.substring(keyed, 16, 15), 16, 10).cast("long"))
    longer = F.lit("".join(str(i % 10) for i in range(max(0, attempt - ROUNDS + 1))))
    part = lambda i: F.xxhash64(seed, F.lit(i))
    last = F.regexp_extract(entity, r"(\.[^.]+)$", 1)
    site = F.regexp_extract(entity, r"@(.*)\.[^.]+$", 1)
    email = F.concat(_letters(F.substring_index(entity, "@", 1), seed), longer, F.lit("@"), _letters(site, part(1)), last)
    octet = lambda i: (F.pmod(part(i), F.lit(254)) + 1).cast("string")
    ip = F.concat_ws(".", octet(0), octet(1), octet(2), octet(3), F.nullif(longer, F.lit("")))
    body = _letters(entity, seed)
    n = F.length(entity)
    # a card keeps its first digit and gets a valid check digit
    front = F.concat(F.substring(entity, 1, 1), body.substr(F.lit(2), n - 2))
    check = F.pmod(F.lit(10) - F.pmod(F.when(kind == "card", _luhn(F.concat(front, F.lit("0")))), F.lit(10)), F.lit(10)).cast("string")
    card = F.concat(front, check, longer)
    # a phone number keeps what comes before its last ten digits, and a 555 exchange
    head = F.greatest(n - 10, F.lit(0))
    tail = body.substr(head + 1, n)
    area = F.concat((F.pmod(part(2), F.lit(8)) + 2).cast("string"), tail.substr(F.lit(2), F.lit(2)))
    exchange = F.when(entity.substr(head + 4, F.lit(3)) == "555", F.lit("555")).otherwise(tail.substr(F.lit(4), F.lit(3)))
    phone = F.when(n >= 10, F.concat(entity.substr(F.lit(1), head), area, exchange, tail.substr(F.lit(7), n), longer)).otherwise(F.concat(body, longer))
    mark = F.regexp_extract(entity, f"^({_MR}|{_MRS})", 1)
    given, family = F.regexp_extract(_bare(entity), r"^(\S+) ", 1), F.regexp_extract(entity, r"(\S+)$", 1)
    chosen = (
        F.when(given == "", "").when(given.isin(*MALE_CYRILLIC), _pick(MALE_CYRILLIC, part(3))).when(given.isin(*FEMALE_CYRILLIC), _pick(FEMALE_CYRILLIC, part(3)))
        .when(given.isin(*FEMALE) | (mark == _MRS), _pick(FEMALE, part(3))).when(given.isin(*MALE) | (mark == _MR), _pick(MALE, part(3))).otherwise(_pick((*MALE, *FEMALE), part(3)))
    )
    latin = F.concat(_pick(SYLLABLES, part(4)), _pick(SYLLABLES, part(5)), _pick(SYLLABLES, part(6)))
    cyrillic = F.concat(_pick(SYLLABLES_CYRILLIC, part(4)), _pick(SYLLABLES_CYRILLIC, part(5)), _pick(SYLLABLES_CYRILLIC, part(6)))
    made = F.initcap(F.concat(F.when(family.rlike(r"\p{IsCyrillic}"), cyrillic).otherwise(latin), F.translate(longer, "0123456789", "abcdefghij")))
    name = F.concat(mark, F.when(chosen == "", made).otherwise(F.concat(chosen, F.lit(" "), made)))
    # an address keeps its zero groups, until all groups are needed to find a free one; no group begins with 0
    group = lambda i: F.regexp_replace(F.substring(F.lower(F.hex(F.xxhash64(seed, i))), 3, 4), "^0", "f")
    groups = F.array_join(F.transform(F.split(entity, ":"), lambda g, i: F.when((g == "0") & F.lit(attempt < ROUNDS), "0").otherwise(F.lpad(group(i), 4, "a"))), ":")
    # a bank account keeps its country, and its check digits are right
    letter = lambda c, i: F.when(c.rlike(r"\d"), F.pmod(F.xxhash64(seed, i), F.lit(10)).cast("string")).otherwise(_pick(_UPPER, F.xxhash64(seed, i)))
    account = F.array_join(F.transform(F.split(F.substring(entity, 5, 40), ""), letter), "")
    account = F.concat(account, F.translate(longer, "0123456789", "ABCDEFGHIJ"))
    left = _mod97(F.concat(F.substring(entity, 1, 2), F.lit("00"), account))
    iban = F.concat(F.substring(entity, 1, 2), F.lpad((98 - left).cast("string"), 2, "0"), account)
    return F.when(kind == "email", email).when(kind == "ip", ip).when(kind == "ip6", groups).when(kind == "ssn", F.concat(body, longer)).when(kind == "iban", iban).when(kind == "card", card).when(kind == "phone", phone).otherwise(name)


def render(kind: Column, mention: Column, canon: Column) -> Column:
    """The canonical surrogate in the mention's own format."""
    title = F.regexp_extract(mention, rf"^((?:{_TITLE})\.? )", 1)
    alone = ~F.regexp_replace(mention, rf"^(?:{_TITLE})\.? ", "").contains(" ")
    named = F.when(alone, F.substring_index(canon, " ", -1)).otherwise(_bare(canon))
    chars = F.split(mention, "")
    count = lambda i: F.size(F.filter(F.slice(chars, F.lit(1), i), lambda c: c.rlike(r"\d")))
    last = F.size(F.filter(chars, lambda c: c.rlike(r"\d")))
    cased = F.when(mention == F.upper(mention), F.upper(canon)).otherwise(canon)
    # the country code that the entity doesn't have stays
    code = F.when((kind == "phone") & mention.startswith("+1") & (last == 11), F.lit(1)).otherwise(F.lit(0))
    canon_digits = F.when(code == 1, F.concat(F.lit("1"), canon)).otherwise(canon)
    poured = F.array_join(F.transform(chars, lambda c, i: F.when(c.rlike(r"\d"), canon_digits.substr(count(i) + 1, F.lit(1))).otherwise(c)), "")
    seen = lambda i: F.size(F.filter(F.slice(chars, F.lit(1), i), lambda c: c != " "))
    spread = F.array_join(F.transform(chars, lambda c, i: F.when(c == " ", c).otherwise(canon.substr(seen(i) + 1, F.lit(1)))), "")
    signs = F.size(F.filter(chars, lambda c: c != " "))
    # an address with :: has its groups before and behind it, if those between are still zeros
    own, sides = F.split(canon, ":"), F.split(mention, "::")
    n_left, n_right = (F.size(F.filter(F.split(F.get(sides, i), ":"), lambda g: g != "")) for i in (0, 1))
    middle = F.slice(own, n_left + 1, F.greatest(F.lit(8) - n_left - n_right, F.lit(0)))
    short = F.concat(F.array_join(F.slice(own, F.lit(1), n_left), ":"), F.lit("::"), F.array_join(F.slice(own, F.lit(9) - n_right, n_right), ":"))
    full = F.array_join(F.transform(own, lambda g, i: F.lpad(g, F.greatest(F.length(g), F.length(F.get(F.split(mention, ":"), i))), "0")), ":")
    address = F.when(mention.contains("::"), F.when(F.forall(middle, lambda g: g == "0"), short).otherwise(canon)).otherwise(full)
    address = F.when(mention == F.upper(mention), F.upper(address)).otherwise(address)
    return F.when(kind == "ip6", address).when(kind.isin("card", "phone", "ssn"), F.concat(poured, canon_digits.substr(last + 1, F.length(canon_digits)))).when(kind == "iban", F.concat(spread, canon.substr(signs + 1, F.length(canon)))).when(kind == "email", cased).when(kind == "name", F.concat(title, named)).otherwise(canon)


def assign(entities: DataFrame, key: str) -> DataFrame:
    """kind, entity, surrogate: distinct surrogates that are no entity of the corpus themselves.

    In each round the open entities propose a surrogate; of several that propose one the least entity gets it, unless it
    is taken or a real entity's. The others go to the next round, which is rarely needed.
    """
    entities = materialize(entities.select("kind", "entity").distinct(), "surrogate-entities")
    open_, done, attempt = entities, None, 0
    while True:
        offered = materialize(open_.withColumn("surrogate", surrogate(F.col("kind"), F.col("entity"), key, attempt)), "surrogate-offered")
        taken = entities.select("kind", F.col("entity").alias("surrogate"))
        if done is not None:
            taken = taken.unionByName(done.select("kind", "surrogate"))
        first = F.row_number().over(Window.partitionBy("kind", "surrogate").orderBy("entity")) == 1
        good = materialize(offered.withColumn("first", first).where("first").drop("first").join(taken, ["kind", "surrogate"], "left_anti").select("kind", "entity", "surrogate"), "surrogate-good")
        done = good if done is None else done.unionByName(good)
        open_ = materialize(offered.select("kind", "entity").join(good, ["kind", "entity"], "left_anti"), "surrogate-open")
        if open_.isEmpty():
            return done
        attempt += 1


def replace_entities(docs: DataFrame, key: str) -> DataFrame:
    """``docs`` with personal data in text replaced, and n_entities, the number of mentions (with an underscore more where
    ``docs`` has such a column). Other columns stay. ``key`` is secret: who has it can test guesses.

    Emails, phone, card, social security and bank account (IBAN) numbers, IP addresses and persons' names are found by form; of
    cards and accounts the check digits have to be right, all spellings of an IPv6 address are one. An entity has the same surrogate
    wherever it is mentioned, in the mention's own format (separators, case, title); different entities have different
    ones. A surname behind a title is the person of the one full name of its text that it fits. Names keep gender and script, letters their script and case, cards a valid check digit. Null text stays null
    with 0 mentions; n_chars, where there is one, isn't changed. Equal texts get equal results.
    """
    has = F.coalesce(F.when(F.col("text").contains("@"), F.col("text").rlike(ANY)).otherwise(F.col("text").rlike(NO_EMAIL)), F.lit(False))
    _text, _map, _found, _gaps = (free(docs, f"_pii_{x}") for x in ("text", "map", "found", "gaps"))
    number = free(docs, "n_entities")
    plain = docs.where(~has).withColumn(number, F.lit(0).cast("long"))
    docs = docs.where(has)
    found = F.regexp_extract_all("text", F.lit(ANY), F.lit(0))
    # a text's own hash is its key, so that copies are looked up once
    mentions = docs.select(F.sha2("text", 256).alias(_text), F.explode(F.array_distinct(found)).alias("mention")).distinct()
    mentions = mentions.withColumn("kind", kind_of(F.col("mention"))).where(valid(F.col("kind"), F.col("mention"))).withColumn("entity", canonical(F.col("kind"), F.col("mention")))
    mentions = materialize(linked(materialize(mentions, "surrogate-found"), _text), "surrogate-mentions")
    table = assign(mentions, key)
    named = mentions.join(table, ["kind", "entity"]).select(_text, "mention", render(F.col("kind"), F.col("mention"), F.col("surrogate")).alias("to"))
    maps = named.groupBy(_text).agg(F.map_from_entries(F.collect_set(F.struct("mention", "to"))).alias(_map))
    docs = docs.withColumn(_text, F.sha2("text", 256)).join(maps, _text, "left")
    gaps = F.split("text", ANY, -1)
    new = F.transform(_found, lambda m: F.try_element_at(_map, m))
    docs = docs.withColumn(_found, found).withColumn(_gaps, gaps)
    # a mention that isn't what its form says stays
    whole = F.array_join(F.transform(_gaps, lambda g, i: F.concat(g, F.coalesce(F.get(new, i), F.get(_found, i), F.lit("")))), "")
    docs = docs.withColumn("text", whole).withColumn(number, F.size(F.filter(new, lambda m: m.isNotNull())).cast("long")).drop(_text, _map, _found, _gaps)
    return plain.unionByName(docs.select(*plain.columns))


#: The registered query's key; a real one is given by the caller and kept secret.
QUERY_KEY = "a public key for the registered query"


def op1_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return replace_entities(docs, QUERY_KEY).select("doc_id", "text", "n_entities")
