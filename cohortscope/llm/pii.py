"""Surrogates for personal data: keyed, of the same type and format, distinct, and the same wherever a thing recurs.

Detected entities are reduced to units (an address, a number, a name's word) in a normal form. A unit's surrogate
is drawn from a keyed hash of the normal form, so the same thing gets the same surrogate in every document, and is
written in the format of each place: separators and letter case stay, so do first digits, a valid card number stays
valid, names keep their gender and script. A name is found behind a title, and its words are replaced wherever they
stand in the same text. The surrogates of all different units are checked against each other and against the real
units; those that clash are drawn again until none does. All of it is SQL expressions; texts are rewritten in place,
and only units are shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortscope.llm.shared import broadcast_if_small, land, let

#: Titles by the gender they tell, and syllables of invented names by script.
TITLES = {
    "f": ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra", "Doña", "Госпожа", "Κυρία"),
    "m": ("Mr", "Herr", "Monsieur", "Señor", "Sr", "Don", "Господин", "Κύριος"),
    "n": ("Dr", "Prof", "Professor"),
}
SYLLABLES = {
    "latin": "ba be bi bo da de di do fa fe fi ga gi ka ke ki la le li lo ma me mi mo na ne ni no ra re ri ro sa se si "
             "ta te ti to va ve vi vo za",
    "cyrillic": "ба бе би бо ва ве ви во да де ди до за зе ка ке ки ла ле ли ло ма ме ми мо на не ни но ра ре ри ро са "
                "се си та те ти то",
    "greek": "βα βε βι βο γα γε δα δε δι δο ζα κα κε κι κο λα λε λι λο μα με μι μο να νε νι νο ρα ρε ρι ρο σα σε σι "
             "τα τε τι το",
}
#: Endings that tell the gender of an invented first name.
ENDINGS = {"latin": {"f": "na", "m": "rd"}, "cyrillic": {"f": "на", "m": "рд"}, "greek": {"f": "να", "m": "ρδος"}}

_TITLE = "|".join(sorted((t for titles in TITLES.values() for t in titles), key=len, reverse=True))
_WORD = "\\p{Lu}[\\p{L}\\p{M}'’-]{1,40}+"
#: Entities. The bounded and possessive quantifiers keep matching linear in the text; an address has at most the 127
#: labels of 63 characters that a host name can have, other runs of letters and digits may be of any length.
PATTERNS = {
    "email": "(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@(?:[A-Za-z0-9-]{1,63}+\\.){1,127}[A-Za-z]{2,63}+",
    "secret": "(?<![0-9A-Za-z])[0-9A-Fa-f]{32,}+(?![0-9A-Za-z])",
    "ip": "(?<![\\d.])(?:\\d{1,3}\\.){3}\\d{1,3}(?!\\.?\\d)",
    "ssn": "(?<![\\d-])\\d{3}-\\d{2}-\\d{4}(?![\\d-])",
    "card": "(?<![\\d-])(?:\\d{4}[ -]?){3}\\d{1,7}(?!\\d)",
    "name": f"(?<![\\p{{L}}\\p{{M}}])(?:{_TITLE})\\.? {_WORD}(?: {_WORD})?",
}


def _plus(low: int, high: int) -> str:
    """A plus sign and `low` to `high` digits, written out: Java repeats no group in a lookbehind."""
    digit = "[ .()-]{0,3}\\d"
    return "\\+" + digit * low + f"(?:{digit}" * (high - low) + ")?" * (high - low)


#: No group of a phone number: an address or a secret, and, from seven digits on, any other entity with digits.
_NEXT = (f"(?![ .-](?:{PATTERNS['email']}|{PATTERNS['secret']}))(?!(?<={_plus(7, 23)})[ .-]"
         f"(?:{PATTERNS['ip']}|{PATTERNS['ssn']}|{PATTERNS['card']}(?![ -]\\d{{4}}(?!\\d))))")
_PHONE = f"\\+\\d{{1,3}}[ .-]?\\(?\\d{{2,4}}\\)?(?:{_NEXT}[ .-]?\\d{{2,4}}){{2,4}}(?!\\d)"
#: The ten digits after +1; else 15 digits at most, unless more follow without a space.
PATTERNS["phone"] = (
    "(?<![\\d+])(?:\\+1[ .-]?\\(?\\d{3}\\)?[ .-]?\\d{3}[ .-]?\\d{4}(?![.-]?\\d)"
    f"|{_PHONE}(?<!{_plus(16, 23)})(?![.-]?\\d)|{_PHONE})")
PATTERN = "|".join(f"(?:{p})" for p in PATTERNS.values())
KEY = "public test key"
#: Draws in the given form before the form of an address is widened, and before the run stops.
SAME_FORM, MAX_ATTEMPTS = 4, 40
_HEX = 4  # blocks of 64 hex digits that are drawn for a unit


def kind(entity: Column) -> Column:
    """The type of an entity that PATTERN found."""
    return (
        F.when(entity.contains("@"), "email")
        .when(entity.rlike("^[0-9A-Fa-f]{32,}$"), "secret")
        .when(entity.rlike("^\\d{1,3}(\\.\\d{1,3}){3}$"), "ip")
        .when(entity.startswith("+"), "phone")
        .when(entity.rlike("^\\d{3}-\\d{2}-\\d{4}$"), "ssn")
        .when(entity.rlike("^\\d"), "card")
        .otherwise("name")
    )


def _script(word: Column) -> Column:
    return F.when(word.rlike("\\p{IsCyrillic}"), "cyrillic").when(word.rlike("\\p{IsGreek}"), "greek") \
        .otherwise("latin")


def _gender(entity: Column) -> Column:
    """What the title tells; names are given without an ending of their gender where it tells none."""
    return F.when(entity.rlike(f"^(?:{'|'.join(TITLES['f'])})\\b"), "f").when(
        entity.rlike(f"^(?:{'|'.join(TITLES['n'])})\\b"), "n").otherwise("m")


def units(entity: Column) -> Column:
    """The units of an entity as "type:normal form". A name has one for each word: a surname, or both names."""

    def named(of: Column) -> Column:
        words = F.split(F.regexp_replace(of, f"^(?:{_TITLE})\\.? ", ""), " ")
        return let(words, lambda own: F.transform(own, lambda word, i: F.concat(
            F.when(i == F.size(own) - 1, "last").otherwise(F.concat(F.lit("first_"), _gender(of))),
            F.lit("_"), _script(word), F.lit(":"), F.lower(word))))

    digits = F.regexp_replace(entity, "\\D", "")
    return let(kind(entity), lambda type_: F.when(type_ == "name", named(entity)).otherwise(F.array(F.concat(
        type_, F.lit(":"),
        F.when(type_.isin("email", "secret"), F.lower(entity)).when(type_ == "ip", entity).otherwise(digits)))))


def _drawn(unit: Column, attempt: Column, key: str) -> Column:
    """Hex digits from the key, the unit and the attempt."""
    return F.concat(*[
        F.sha2(F.concat_ws("|", F.lit(key), F.lit(str(block)), attempt.cast("string"), unit), 256)
        for block in range(_HEX)
    ])


def _number(drawn: Column, i: Column) -> Column:
    """The i-th number from 0 to 65535 (from 0) of the drawn digits, which are used in turn."""
    at = (i * 4) % (64 * _HEX) + 1
    return F.conv(F.substring(drawn, at, F.lit(4)), 16, 10).cast("int")


def _characters(form: Column, drawn: Column, first: Column) -> Column:
    """Letters for letters and digits for digits, drawn from place `first` on; other characters stay."""
    return F.array_join(F.transform(F.split(form, ""), lambda c, i: let(_number(drawn, i + first), lambda n: (
        F.when(c.rlike("[0-9]"), (n % 10).cast("string"))
        .when(c.rlike("[a-z]"), F.substring(F.lit("abcdefghijklmnopqrstuvwxyz"), n % 26 + 1, F.lit(1)))
        .otherwise(c)))), "")


def _hex(drawn: Column, length: Column) -> Column:
    """`length` hex digits: the drawn ones, and where they are too few, further blocks hashed from them."""
    further = F.transform(F.sequence(F.lit(1), F.ceil(length / 64).cast("int")), lambda block: F.sha2(
        F.concat_ws("|", drawn, block.cast("string")), 256))
    return F.when(length <= 64 * _HEX, F.substring(drawn, F.lit(1), length)).otherwise(
        F.substring(F.concat(drawn, F.array_join(further, "")), F.lit(1), length))


def _luhn_sum(digits: Column) -> Column:
    """The sum whose last digit is 0 for a valid card number."""
    return F.aggregate(F.transform(F.split(F.reverse(digits), ""), lambda c, i: let(
        c.cast("int") * (i % 2 + 1), lambda x: F.when(x > 9, x - 9).otherwise(x))),
        F.lit(0), lambda a, x: a + x)


def _card(form: Column, drawn: Column) -> Column:
    """Digits that begin like `form` and are a valid card number if and only if `form` is one."""
    body = F.concat(F.substring(form, 1, 1), _characters(F.substring(form, F.lit(2), F.length(form) - 2), drawn, F.lit(0)))

    def closed(own: Column) -> Column:
        check = (10 - _luhn_sum(F.concat(own, F.lit("0"))) % 10) % 10
        other = (check + 1 + _number(drawn, F.lit(63)) % 9) % 10
        return F.concat(own, F.when(_luhn_sum(form) % 10 == 0, check).otherwise(other).cast("string"))

    return let(body, closed)


def _name(type_: Column, form: Column, drawn: Column, attempt: Column) -> Column:
    result = F.lit(None).cast("string")
    for script, syllables in SYLLABLES.items():
        known = F.split(F.lit(syllables), " ")
        count = F.when(type_.startswith("last"), 3).otherwise(2) + attempt
        stem = _stem(known, drawn, count)
        ending = F.when(type_.startswith("first_f"), ENDINGS[script]["f"]).when(
            type_.startswith("first_m"), ENDINGS[script]["m"]).otherwise("")
        result = F.when(type_.endswith(script), F.concat(stem, ending)).otherwise(result)
    return result


def _stem(known: Column, drawn: Column, count: Column) -> Column:
    return F.array_join(F.transform(F.sequence(F.lit(1), count), lambda i: F.get(
        known, _number(drawn, i) % F.size(known))), "")


def surrogate(unit: Column, attempt: Column, key: str) -> Column:
    """The normal form of a unit's surrogate."""
    type_, form = F.substring_index(unit, ":", 1), F.substring(unit, F.locate(":", unit) + 1, F.lit(1 << 20))

    def made(drawn: Column) -> Column:
        at = F.instr(form, "@")
        domain = F.substring(form, at + 1, F.lit(1 << 20))
        end = F.regexp_extract(domain, "\\.[a-z]+$", 0)
        host = F.substring(domain, F.lit(1), F.length(domain) - F.length(end))
        # The host depends on the host alone, so addresses of one host stay together.
        # After some draws a letter more each time: a short form may have no free value.
        wider = F.array_join(F.transform(
            F.sequence(F.lit(1), F.greatest(attempt - SAME_FORM, F.lit(0)) + 1),
            lambda i: F.substring(F.lit("abcdefghijklmnopqrstuvwxyz"), _number(drawn, 62 - i % 32) % 26 + 1, F.lit(1))), "")
        further = F.when(attempt > SAME_FORM, wider).otherwise("")
        email = F.concat(_characters(F.substring(form, F.lit(1), at - 1), drawn, F.lit(0)), further, F.lit("@"),
                         let(_drawn(host, F.lit(0), key), lambda own: _characters(host, own, F.lit(0))), end)
        ip = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: (
            1 + _number(drawn, i) % 254).cast("string")), ".")
        return (
            F.when(type_ == "email", email)
            .when(type_ == "secret", _hex(drawn, F.length(form)))
            .when(type_ == "ip", ip)
            .when(type_ == "phone", F.concat(F.substring(form, 1, 1), _characters(
                F.substring(form, F.lit(2), F.length(form)), drawn, F.lit(0))))
            .when(type_ == "ssn", _characters(form, drawn, F.lit(0)))
            .when(type_ == "card", _card(form, drawn))
            .otherwise(_name(type_, form, drawn, attempt))
        )

    return let(_drawn(unit, attempt, key), made)


def _written(entity: Column, drawn: Column) -> Column:
    """The surrogates of an entity's units, in the format of the entity."""

    def like(form: Column, core: Column) -> Column:
        """The characters of `core` in the places of the letters and digits of `form`, in their case."""
        places = F.transform(F.split(form, ""), lambda c: F.when(c.rlike("[0-9A-Za-z]"), c).otherwise(None))
        kept = F.regexp_replace(core, "[^0-9A-Za-z]", "")
        return let(places, lambda own: F.array_join(F.transform(F.split(form, ""), lambda c, i: F.when(
            F.get(own, i).isNotNull(), let(
                F.substring(kept, F.size(F.filter(F.slice(own, F.lit(1), i + 1), lambda x: x.isNotNull())), F.lit(1)),
                lambda new: F.when(c.rlike("[A-Z]"), F.upper(new)).otherwise(new))).otherwise(c)), ""))

    def cased(form: Column, core: Column) -> Column:
        """`core` in the letter case of `form`, place by place; both have the same length."""
        return F.array_join(F.zip_with(F.split(form, ""), F.split(core, ""), lambda c, new: F.when(
            c.rlike("[A-Z]"), F.upper(new)).otherwise(new)), "")

    title = F.regexp_extract(entity, f"^(?:{_TITLE})\\.? ", 0)
    return let(kind(entity), lambda type_: (
        F.when(type_ == "name", F.concat(title, F.array_join(F.transform(drawn, lambda w: F.initcap(w)), " ")))
        .when(type_ == "ip", drawn[0])
        .when((type_ == "secret") & entity.rlike("[A-F]") & ~entity.rlike("[a-f]"), F.upper(drawn[0]))
        .when(type_.isin("email", "secret"), cased(entity, drawn[0]))
        .otherwise(like(entity, drawn[0]))))


def _entities(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0))


_BOUNDS = "(?<![\\p{L}\\p{M}])", "(?![\\p{L}\\p{M}])"


def _named_words(text: Column, entities: Column) -> Column:
    """The words of the names among `entities`, with the unit each stands for, as structs (word, unit); the first name
    decides. A word that the text also has in lower case is an ordinary one and left out."""
    names = F.filter(entities, lambda e: kind(e) == "name")
    pairs = F.flatten(F.transform(names, lambda e: F.arrays_zip(
        F.split(F.regexp_replace(e, f"^(?:{_TITLE})\\.? ", ""), " ").alias("word"), units(e).alias("unit"))))
    pairs = F.transform(pairs, lambda p: F.struct(p["word"].alias("word"), p["unit"].alias("unit")))
    return let(pairs, lambda own: F.filter(own, lambda p, i: (
        ~F.exists(F.slice(own, F.lit(1), i), lambda q: q["word"] == p["word"])
        & ~F.regexp_like(text, F.concat(F.lit(_BOUNDS[0]), F.lower(p["word"]), F.lit(_BOUNDS[1]))))))


def _with_names(words: Column) -> Column:
    """The pattern of all entities and of the words, wherever they stand."""
    listed = F.array_join(F.transform(words, lambda p: p["word"]), "|")
    return F.concat(F.lit(f"{PATTERN}|{_BOUNDS[0]}(?:"), listed, F.lit(f"){_BOUNDS[1]}"))


def clashes(docs: DataFrame, key: str) -> DataFrame:
    """Units whose first surrogate is not their own, with the attempt that is: (unit, attempt), attempt over 0.

    A surrogate is not a unit's own if a smaller unit of the type has it, or if it is itself a unit found in the
    documents. Each round draws again for those units only. Names and addresses may grow with the attempt, numbers
    keep their form: where the documents leave no number of a form free, the run stops and names the type.
    """
    found = land(docs.select(F.explode(_entities(F.col("text"))).alias("entity"))
                 .select(F.explode(units(F.col("entity"))).alias("unit")).distinct(), "pii_units")
    type_ = F.substring_index("unit", ":", 1)
    given = land(found.select("unit", F.lit(0).alias("attempt"), F.concat(
        type_, F.lit(":"), surrogate(F.col("unit"), F.lit(0), key)).alias("given")), "pii_given")
    while True:
        taken = given.groupBy("given").agg(F.min("unit").alias("owner"), F.count("*").alias("n"))
        real = found.select(F.col("unit").alias("given"), F.lit(True).alias("is_real"))
        wrong = land(
            given.join(taken, "given").join(real, "given", "left")
            .where((F.col("unit") != F.col("owner")) | F.col("is_real")).select("unit", "attempt"), "pii_wrong")
        if wrong.isEmpty():
            return given.where("attempt > 0").select("unit", "attempt")
        stuck = wrong.where(F.col("attempt") >= MAX_ATTEMPTS).groupBy(type_.alias("type")).agg(F.count("*").alias("n"))
        full = [f"{r['type']} ({r['n']})" for r in stuck.orderBy("type").collect()]  # a line a type
        if full:
            raise ValueError(f"no free surrogate after {MAX_ATTEMPTS} draws: {', '.join(full)}")
        again = wrong.select("unit", (F.col("attempt") + 1).alias("attempt"))
        again = again.select("unit", "attempt", F.concat(
            type_, F.lit(":"), surrogate(F.col("unit"), F.col("attempt"), key)).alias("given"))
        given = land(given.join(wrong.select("unit"), "unit", "left_anti").union(again), "pii_given")


def replace(docs: DataFrame, key: str = KEY) -> DataFrame:
    """The documents, with all their columns, with surrogates in `text`. A null text stays null.

    Rows without entities come back as they are; equal texts get equal surrogates.
    """
    redrawn = land(clashes(docs, key), "pii_redrawn")
    attempts, own = "_attempts", docs
    while attempts in docs.columns:
        attempts = f"_{attempts}"
    if redrawn.isEmpty():
        own = docs.withColumn(attempts, F.lit(None).cast("map<string,int>"))
    else:
        used = docs.select("doc_id", F.explode(_entities(F.col("text"))).alias("entity")).select(
            "doc_id", F.explode(units(F.col("entity"))).alias("unit")).distinct()
        by_doc = used.join(broadcast_if_small(redrawn), "unit").groupBy("doc_id").agg(
            F.map_from_entries(F.collect_list(F.struct("unit", "attempt"))).alias(attempts))
        own = docs.join(land(by_doc, "pii_attempts"), "doc_id", "left")
    text = F.col("text")

    def attempt(unit: Column) -> Column:
        return F.coalesce(F.try_element_at(F.col(attempts), unit), F.lit(0))

    def joined(gaps: Column, new: Column) -> Column:
        return F.array_join(F.zip_with(gaps, new, lambda gap, s: F.concat(gap, F.coalesce(s, F.lit("")))), "")

    def given(entity: Column) -> Column:
        return _written(entity, F.transform(units(entity), lambda unit: surrogate(unit, attempt(unit), key)))

    def renamed(words: Column) -> Column:
        """With the names' words replaced wherever they stand; a word alone gets the surrogate that its name has."""
        known = F.map_from_entries(words)

        def each(entity: Column) -> Column:
            alone = F.try_element_at(known, entity)
            return F.when(alone.isNotNull(), F.initcap(surrogate(alone, attempt(alone), key))).otherwise(given(entity))

        return let(_with_names(words), lambda pattern: joined(
            F.split(text, pattern, F.lit(-1)), F.transform(F.regexp_extract_all(text, pattern, F.lit(0)), each)))

    def rewritten(entities: Column) -> Column:
        plain = joined(F.split(text, PATTERN, -1), F.transform(entities, given))
        has_name = F.exists(entities, lambda e: kind(e) == "name")
        with_names = let(_named_words(text, entities), lambda words: F.when(
            F.size(words) > 0, renamed(words)).otherwise(plain))
        return F.when(has_name, with_names).when(F.size(entities) > 0, plain).otherwise(text)

    changed = own.withColumn("text", F.when(text.isNotNull(), let(_entities(text), rewritten)))
    return changed.select(*docs.columns)


def count_entities(text: Column) -> Column:
    return F.coalesce(F.size(_entities(text)), F.lit(0))
