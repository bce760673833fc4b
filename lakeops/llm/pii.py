"""Surrogates for personal data: keyed replacements of the same kind and format, the same for the same entity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.llm.expressions import let, numbered
from lakeops.session import written_out

#: Fixed patterns of the kinds, tried in this order at each place.
_TITLES = {
    "male": "Mr|Herr|Monsieur|Señor|Sr|[Гг]осподин|[Гг]-н|[Κκ]ύριος|[Κκ]ος",
    "female": "Mrs|Ms|Miss|Frau|Madame|Mme|Señora|Sra|[Гг]оспожа|[Гг]-жа|[Κκ]υρία|[Κκ]α",
    "any": "Dr|Prof|[Дд]октор|[Пп]рофессор|[Κκ](?=\\.)|Δρ|Καθ",
}
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "ip": r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?!\.?[0-9])",
    "ssn": r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])",
    "iban": r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![0-9A-Za-z])",
    "card": r"(?<![0-9A-Za-z])(?:[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){2}[ -][0-9]{1,7})(?![0-9A-Za-z])",
    "phone": r"(?<![0-9A-Za-z+])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{2,4}\)[ .-]?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9A-Za-z])|(?<![0-9A-Za-z+])\+[0-9]{1,3}(?:[ .-]?[0-9]{2,4}){2,5}(?![0-9A-Za-z])",
    "person": rf"(?<!\p{{L}})(?:{'|'.join(_TITLES.values())})\.? \p{{Lu}}[\p{{L}}'-]+(?: \p{{Lu}}[\p{{L}}'-]+){{0,2}}",
}
#: A capitalised word, which may be a name that the document has after a title; its possessive ending is not part of it.
WORD = r"(?<![\p{L}'-])\p{Lu}[\p{L}-]+(?:'(?!s(?!\p{L}))[\p{L}-]+)*"
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
#: What every match holds, found much faster: a digit, an at sign, or a title before a capital.
_SIGN = rf"[0-9@]|(?:{'|'.join(_TITLES.values())})\.? \p{{Lu}}"
#: Letters that letters of a script are replaced by, and syllables of made-up names by script: fixed values.
_LETTERS = {r"[a-z]": "abcdefghijklmnopqrstuvwxyz", r"\p{IsGreek}": "αβγδεζηθικλμνξοπρστυφχψω", r"\p{IsCyrillic}": "абвгдежзиклмнопрстуфхцчшэюя", r"\p{L}": "àáâãäåæçèéêëìíîïñòóôõöùúûü"}
_NAMES = {
    r"\p{IsCyrillic}": ("бвгдзклмнпрст", "аеиоу", "а", "нвслр"),
    r"\p{IsGreek}": ("βγδζκλμνπρστ", "αειου", "α", "ςνρλξ"),
    r"\p{L}": ("bdfgjklmnprstvz", "aeiou", "a", "nrslkdt"),
}
SYLLABLES = 4
#: Rounds of moving colliding surrogates on within their format; each is a fresh keyed draw, so few remain after one,
#: except where the format leaves too few. Those are drawn from wider formats from then on, and after as many rounds again
#: addresses from a range that nothing fills.
ROUNDS = 12


def _byte(seed: Column, k: Column) -> Column:
    """The k-th byte (from 0) of a hex digest, which repeats, shifted, after its end."""
    return F.conv(F.substr(seed, k % 31 * 2 + 1, F.lit(2)), 16, 10).cast("int") + k


def _pick(letters: str, n: Column) -> Column:
    return F.substr(F.lit(letters), F.pmod(n, F.lit(len(letters))) + 1, F.lit(1))


def _characters(text: Column, change) -> Column:
    """Each character through ``change`` (character, place from 0), joined."""
    places = F.when(F.length(text) > 0, F.sequence(F.lit(0), F.length(text) - 1)).otherwise(F.array().cast("array<int>"))
    return F.array_join(F.transform(places, lambda k: change(F.substr(text, k + 1, F.lit(1)), k)), "")


def _cased(new: Column, old: Column) -> Column:
    """``new`` in capitals where ``old`` is one."""
    return F.when(old != F.lower(old), F.upper(new)).otherwise(new)


def _scrambled(text: Column, seed: Column) -> Column:
    """Digits for digits and letters for letters of the same script and case; anything else stays."""

    def change(c: Column, k: Column) -> Column:
        n = _byte(seed, k)
        out = F.when(c.rlike("[0-9]"), _pick("0123456789", n))
        for script, letters in _LETTERS.items():
            out = out.when(F.lower(c).rlike(script), _cased(_pick(letters, n), c))
        return out.otherwise(c)

    return _characters(text, change)


def _luhn(digits: Column) -> Column:
    """Checksum of a string of digits, 0 for a valid card number."""
    n = F.length(digits)
    each = F.transform(F.sequence(F.lit(1), n), lambda k: F.struct(F.substr(digits, k, F.lit(1)).cast("int").alias("d"), ((n - k) % 2).alias("twice")))
    doubled = lambda d: F.when(d > 4, d * 2 - 9).otherwise(d * 2)
    return F.aggregate(each, F.lit(0), lambda s, x: s + F.when(x["twice"] == 1, doubled(x["d"])).otherwise(x["d"])) % 10


def _mod97(iban: Column) -> Column:
    """Remainder of an account number, 1 for a valid one: country and check digits last, letters as 10 to 35."""
    turned = F.concat(F.substr(iban, F.lit(5), F.length(iban)), F.substr(iban, F.lit(1), F.lit(4)))
    values = F.transform(F.sequence(F.lit(1), F.length(turned)), lambda k: F.conv(F.substr(turned, k, F.lit(1)), 36, 10).cast("int"))
    return F.aggregate(values, F.lit(0), lambda s, v: F.when(v > 9, s * 100 + v).otherwise(s * 10 + v) % 97)


def _kind(mention: Column) -> Column:
    out = F.when(mention.contains("@"), "email")
    for kind in ("ip", "ssn", "iban", "card", "phone"):
        out = out.when(mention.rlike(f"^(?:{PATTERNS[kind]})$"), kind)
    return out.otherwise("person")


def _gender(mention: Column) -> Column:
    return F.when(mention.rlike(f"^(?:{_TITLES['male']})\\.? "), "male").when(mention.rlike(f"^(?:{_TITLES['female']})\\.? "), "female").otherwise("any")


def _genders(mentions: Column) -> Column:
    """Given names of a document that stand after a title of a gender, to that gender; with both, to the first by name.

    Worked out only where a name stands after a title without one, as nothing else asks for it.
    """

    def given(mention: Column) -> Column:
        words = let(F.split(F.lower(mention), " "), lambda w: F.slice(w, F.lit(2), F.greatest(F.size(w) - 2, F.lit(0))))
        return let(_gender(mention), lambda g: F.transform(words, lambda w: F.struct(w.alias("form"), g.alias("gender"))))

    titled = F.filter(mentions, lambda m: _gender(m) != "any")
    every = F.array_sort(F.array_distinct(F.flatten(F.transform(titled, given))))
    found = let(every, lambda e: F.map_from_entries(F.filter(e, lambda x, k: (k == 0) | (x["form"] != F.get(e, k - 1)["form"]))))
    open_ = F.exists(mentions, lambda m: m.rlike(rf"^(?:{_TITLES['any']})\.? "))
    return F.when(open_, found).otherwise(F.create_map().cast("map<string,string>"))


def _parts(mention: Column, genders: Column) -> Column:
    """Entities of a mention: kind and form. A name's words are entities of their own, so a later short form agrees.

    After a title without a gender a given name has the one that the document's other titles give it.
    """

    def named(words: Column) -> Column:
        def gender(own: Column, w: Column) -> Column:
            return F.when((own == "any") & F.map_contains_key(genders, w), F.element_at(genders, w)).otherwise(own)

        def kinds(own: Column) -> Column:
            given = lambda w: F.concat(F.lit("given-"), gender(own, w))
            return F.transform(words, lambda w, k: F.struct(F.when(k == F.size(words) - 1, "surname").otherwise(given(w)).alias("kind"), w.alias("form")))

        return let(_gender(mention), kinds)

    def entities(kind: Column) -> Column:
        bare = F.when(kind == "email", F.lower(mention)).when(kind == "ip", mention).when(kind == "iban", F.replace(mention, F.lit(" "), F.lit(""))).otherwise(F.regexp_replace(mention, r"[^0-9+]", ""))
        names = let(F.split(F.lower(mention), " "), lambda w: F.slice(w, F.lit(2), F.size(w)))
        return F.when(kind == "person", let(names, named)).otherwise(F.array(F.struct(kind.alias("kind"), bare.alias("form"))))

    return let(_kind(mention), entities)


def _name(form: Column, kind: Column, seed: Column, wide: Column) -> Column:
    """A made-up name in the script of ``form``, of twice the syllables if ``wide``; given names end as the gender's do."""

    def made(onsets: str, vowels: str, female: str, finals: str) -> Column:
        syllables = F.array_join(F.transform(F.sequence(F.lit(0), F.when(wide, 2 * SYLLABLES - 1).otherwise(SYLLABLES - 1)), lambda k: F.concat(_pick(onsets, _byte(seed, k * 2)), _pick(vowels, _byte(seed, k * 2 + 1)))), "")
        end = F.when(kind == "given-female", F.lit(female)).when(kind == "given-male", _pick(finals, _byte(seed, F.lit(20)))).otherwise(F.lit(""))
        return F.concat(F.when(kind == "given-female", F.substr(syllables, F.lit(1), F.length(syllables) - 1)).otherwise(syllables), end)

    (first, *more) = _NAMES.items()
    out = F.when(form.rlike(first[0]), made(*first[1]))
    for script, parts in more[:-1]:
        out = out.when(form.rlike(script), made(*parts))
    return out.otherwise(made(*more[-1][1]))


def _digest(key: str, *parts: Column) -> Column:
    return F.sha2(F.concat_ws("\u0001", F.lit(key), *parts).cast("binary"), 256)


def _email(form: Column, seed: Column, wide: Column, key: str) -> Column:
    """Local part and host by themselves, so the addresses of one host keep one; the last label stays.

    A wide local part is 16 characters longer.
    """
    host, top = F.substring_index(form, "@", -1), F.substring_index(form, ".", -1)
    labels = F.substr(host, F.lit(1), F.length(host) - F.length(top))
    at_host = let(_digest(key, F.lit("host"), host), lambda own: let(labels, lambda part: _scrambled(part, own)))
    longer = F.when(wide, F.substr(seed, F.lit(33), F.lit(16))).otherwise("")
    return F.concat(let(F.substring_index(form, "@", 1), lambda local: _scrambled(local, seed)), longer, F.lit("@"), at_host, top)


def _address(form: Column, seed: Column, attempt: Column) -> Column:
    """Private ranges stay; a public first part is drawn from 11 to 110, clear of them.

    Where a range is too full, a private address is drawn from 10.x.y.z, and at last any from the private range of IPv6.
    """
    octets = F.split(form, r"\.")
    kept = F.when(form.rlike(r"^(10|127)\."), 1).when(form.rlike(r"^(192\.168|172\.(1[6-9]|2[0-9]|3[01]))\."), 2).otherwise(0)
    first = (F.pmod(_byte(seed, F.lit(0)), F.lit(100)) + 11).cast("string")
    other = lambda k: (F.pmod(_byte(seed, k * 2) * 256 + _byte(seed, k * 2 + 1), F.lit(254)) + 1).cast("string")
    near = let(kept, lambda n: F.array_join(F.transform(octets, lambda o, k: F.when(k < n, o).when(k == 0, first).otherwise(other(k))), "."))
    ten = F.concat_ws(".", F.lit("10"), *[other(F.lit(k)) for k in (1, 2, 3)])
    sixth = F.concat(F.lit("fd"), F.substr(seed, F.lit(33), F.lit(2)), *[F.concat(F.lit(":"), F.substr(seed, F.lit(35 + 4 * k), F.lit(4))) for k in range(7)])
    return F.when(attempt < ROUNDS, near).when((attempt < 2 * ROUNDS) & (kept > 0), ten).when(attempt < 2 * ROUNDS, near).otherwise(sixth)


def _card(form: Column, scrambled: Column) -> Column:
    """The first digit stays, and the last makes the checksum what it was."""
    n = F.length(form)

    def checked(body: Column) -> Column:
        last = F.pmod(F.substr(body, n, F.lit(1)).cast("int") + _luhn(form) - _luhn(body), F.lit(10))
        return F.concat(F.substr(body, F.lit(1), n - 1), last.cast("string"))

    return let(F.concat(F.substr(form, F.lit(1), F.lit(1)), F.substr(scrambled, F.lit(2), n)), checked)


def _account(form: Column, scrambled: Column, seed: Column) -> Column:
    """The country stays, and a valid number has a valid surrogate."""
    country, rest = F.substr(form, F.lit(1), F.lit(2)), F.substr(scrambled, F.lit(5), F.length(form))
    valid = let(F.concat(country, F.lit("00"), rest), lambda body: 98 - _mod97(body))
    check = F.when(_mod97(form) == 1, valid).otherwise(F.pmod(_byte(seed, F.lit(30)), F.lit(97)))
    return F.concat(country, F.lpad(check.cast("string"), 2, "0"), rest)


def _longer(seed: Column, wide: Column) -> Column:
    """Eighteen digits more for a wide number."""
    return F.when(wide, F.array_join(F.transform(F.sequence(F.lit(0), F.lit(17)), lambda k: _pick("0123456789", _byte(seed, k + 12))), "")).otherwise("")


def _phone(form: Column, scrambled: Column) -> Column:
    lead = F.when(form.startswith("+"), 2).otherwise(1)
    return F.concat(F.substr(form, F.lit(1), lead), F.substr(scrambled, lead + 1, F.length(form)))


def surrogate(kind: Column, form: Column, attempt: Column, key: str) -> Column:
    """The surrogate of an entity in its plain form, drawn from the key, the entity and the attempt; a late one is wide."""
    wide = attempt >= ROUNDS

    def drawn(form: Column, seed: Column) -> Column:
        mixed = lambda use: let(_scrambled(form, seed), use)
        return (
            F.when(kind == "email", _email(form, seed, wide, key))
            .when(kind == "ip", _address(form, seed, attempt))
            .when(kind == "card", mixed(lambda s: _card(form, s)))
            .when(kind == "phone", mixed(lambda s: F.concat(_phone(form, s), _longer(seed, wide))))
            .when(kind == "iban", mixed(lambda s: _account(form, s, seed)))
            .when(kind == "ssn", mixed(lambda s: F.concat(s, _longer(seed, wide))))
            .otherwise(_name(form, kind, seed, wide))
        )

    return let(form, lambda f: let(_digest(key, kind, f, attempt.cast("string")), lambda seed: drawn(f, seed)))


def _laid(mention: Column, found: Column) -> Column:
    """The surrogates of a mention's entities in the mention's own format."""

    def filled(plain: Column, skipped: str) -> Column:
        # Characters of the mention take those of the surrogate in turn; spaces, brackets and hyphens stay.
        counted = lambda k: F.length(F.regexp_replace(F.substr(mention, F.lit(1), k + 1), skipped, ""))
        same = _characters(mention, lambda c, k: F.when(c.rlike(skipped), c).otherwise(F.substr(plain, counted(k), F.lit(1))))
        # What a wide surrogate has more goes to the end.
        return F.concat(same, F.substr(plain, F.length(F.regexp_replace(mention, skipped, "")) + 1, F.length(plain)))

    def laid(kind: Column, new: Column) -> Column:
        plain = F.get(new, F.lit(0))
        old = let(F.split(mention, " "), lambda w: F.slice(w, F.lit(2), F.size(w)))
        names = F.zip_with(old, new, lambda o, n: F.when((F.length(o) > 1) & (o == F.upper(o)), F.upper(n)).otherwise(F.initcap(n)))
        return (
            F.when(kind == "email", F.when(mention == F.upper(mention), F.upper(plain)).otherwise(plain))
            .when(kind == "ip", plain)
            .when(kind == "iban", filled(plain, " "))
            .when(kind == "person", F.concat(F.substring_index(mention, " ", 1), F.lit(" "), F.array_join(names, " ")))
            .otherwise(filled(plain, "[^0-9+]"))
        )

    return let(found, lambda new: let(_kind(mention), lambda kind: laid(kind, new)))


def _has_entity(text: Column) -> Column:
    return text.rlike(_SIGN) & text.rlike(ANY)


def _mentions(text: Column) -> Column:
    return F.when(text.rlike(_SIGN), F.regexp_extract_all(text, F.lit(ANY), F.lit(0))).otherwise(F.array().cast("array<string>"))


def _known(entities: Column) -> Column:
    """Name words after the titles of a document: form (without a possessive ending) to entity; a surname before a given name."""
    names = F.filter(entities, lambda e: e["kind"].startswith("given") | (e["kind"] == "surname"))
    keyed = F.transform(names, lambda e: F.struct(F.regexp_replace(e["form"], "'s$", "").alias("form"), (e["kind"] != "surname").alias("given"), e.alias("entity")))
    every = F.array_sort(F.array_distinct(keyed))
    first = F.filter(every, lambda x, k: (k == 0) | (x["form"] != F.get(every, k - 1)["form"]))
    return F.map_from_entries(F.transform(first, lambda x: F.struct(x["form"], x["entity"])))


def _entities(mentions: Column) -> Column:
    return let(mentions, lambda all_: let(_genders(all_), lambda genders: F.flatten(F.transform(all_, lambda m: _parts(m, genders)))))


def collisions(entities: DataFrame, key: str) -> DataFrame:
    """kind, form and attempt of the entities whose first draw can't stand; ``entities`` has distinct kind and form.

    A draw can't stand when another entity has it, the least form excepted, or when it is itself an entity of the text.
    Such entities draw again, until none is left: from ROUNDS on from formats with room for any number of them.
    """
    draw = surrogate(F.col("kind"), F.col("form"), F.col("attempt"), key)
    group = F.when(F.col("kind").startswith("given"), F.lit("given")).otherwise(F.col("kind"))
    names = entities.select(group.alias("of"), F.col("form").alias("taken")).distinct()
    now = written_out(entities.withColumn("attempt", F.lit(0)).withColumn("group", group).withColumn("draw", draw))
    while True:
        # Least first by attempt: who stands already is not moved by a newcomer.
        owner = now.groupBy("group", "draw").agg(F.min(F.struct("attempt", "kind", "form")).alias("owner"), F.count(F.lit(1)).alias("n")).where("n > 1")
        bad = now.join(owner, ["group", "draw"]).where(F.struct("attempt", "kind", "form") != F.col("owner")).select("kind", "form")
        same = now.join(names, (F.col("group") == F.col("of")) & (F.col("draw") == F.col("taken")), "left_semi").select("kind", "form")
        bad = written_out(bad.union(same).distinct())
        if not bad.limit(1).count():
            return now.where("attempt > 0").select("kind", "form", "attempt")
        moved = now.join(bad.withColumn("moved", F.lit(1)), ["kind", "form"], "left")
        moved = moved.withColumn("attempt", F.col("attempt") + F.coalesce("moved", F.lit(0)))
        now = written_out(moved.select("kind", "form", "attempt", "group", F.when(F.col("moved").isNull(), F.col("draw")).otherwise(draw).alias("draw")))


def pseudonymised(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with every personal entity replaced in the text, and ``entities``, the kinds found, in order.

    Kinds are those of PATTERNS; names are found after a title, and their words, capitalised, anywhere else in the same
    document, where each counts as a person; names that have no title in a document are not found there. A surrogate is drawn with a keyed hash from the entity
    alone, so it is the same everywhere (in any spelling of case, spaces or brackets), and keeps what the entity shows of
    its kind: letters, digits and their case and script, the gender of a given name, an address range, a card's or
    account's checksum. No two entities of the corpus share one, and none is itself an entity of the corpus; the
    few draws that would are moved on, and only those are joined back to the documents.

    Whole texts are rewritten; text around entities stays as it is. A null text stays null with no entities, an empty one
    empty. Equal rows stay equal; null ids don't matter. An empty table gives an empty table, and a column ``entities`` is
    replaced.
    """
    docs, own = numbered(docs, [c for c in docs.columns if c != "entities"])
    text = F.col(own[text_col])
    found = docs.where(_has_entity(text)).select(F.col(own[id_col]).alias("__id"), F.xxhash64(text).alias("__mark"), F.explode(_entities(_mentions(text))).alias("e"))
    found = written_out(found.select("__id", "__mark", "e.kind", "e.form").distinct())
    moved = written_out(collisions(found.select("kind", "form").distinct(), key))
    # A document's own entities: bounded by the document. All of them grow with the documents, so the join is shuffled.
    per = found.join(moved, ["kind", "form"]).groupBy("__id", "__mark").agg(F.map_from_entries(F.collect_set(F.struct(F.concat_ws("\u0001", "kind", "form"), "attempt"))).alias("moves"))
    per = written_out(per).hint("merge").select(F.col("__id").alias("__of"), F.col("__mark").alias("__m"), "moves")
    out = docs.join(per, F.col(own[id_col]).eqNullSafe(F.col("__of")) & (F.xxhash64(text) == F.col("__m")), "left")

    def put(mention: Column) -> Column:
        return _laid(mention, F.transform(_parts(mention, F.col("__genders")), lambda e: let(tries(e), lambda n: surrogate(e["kind"], e["form"], n, key))))

    def bare(gap: Column, known: Column) -> Column:
        """Text between mentions with the document's name words replaced, and how many there are."""

        def word(w: Column) -> Column:
            person = F.element_at(known, F.lower(w))
            new = lambda e: F.regexp_replace(surrogate(e["kind"], e["form"], tries(e), key), "'s$", "")
            cased = let(person, lambda e: let(new(e), lambda n: F.when(w == F.upper(w), F.upper(n)).otherwise(F.initcap(n))))
            return F.when(F.map_contains_key(known, F.lower(w)), cased).otherwise(w)

        words = F.regexp_extract_all(gap, F.lit(WORD), F.lit(0))
        joined = F.zip_with(F.split(gap, WORD, -1), F.transform(words, word), lambda between, w: F.concat(between, F.coalesce(w, F.lit(""))))
        count = F.size(F.filter(words, lambda w: F.map_contains_key(known, F.lower(w))))
        return F.struct(F.when(count > 0, F.array_join(joined, "")).otherwise(gap).alias("text"), count.alias("n"))

    tries = lambda e: F.coalesce(F.element_at("moves", F.concat_ws("\u0001", e["kind"], e["form"])), F.lit(0))
    mentions, gaps = _mentions(text), F.split(text, ANY, -1)
    between = let(_known(_entities(mentions)), lambda known: F.when(F.size(known) > 0, F.transform(gaps, lambda g: bare(g, known))).otherwise(F.transform(gaps, lambda g: F.struct(g.alias("text"), F.lit(0).alias("n")))))
    parts = F.zip_with(between, mentions, lambda gap, m: F.struct(gap["text"].alias("gap"), gap["n"].alias("n"), m.alias("mention")))
    row = out.withColumns({"__parts": F.when(text.rlike(_SIGN), parts), "__genders": _genders(_mentions(text))})
    changed = F.array_join(F.transform("__parts", lambda p: F.concat(p["gap"], F.coalesce(put(p["mention"]), F.lit("")))), "")
    kinds = F.flatten(F.transform("__parts", lambda p: F.concat(F.array_repeat(F.lit("person"), p["n"]), F.when(p["mention"].isNull(), F.array().cast("array<string>")).otherwise(F.array(_kind(p["mention"]))))))
    kinds = F.coalesce(kinds, F.array().cast("array<string>"))
    return row.select(*[(F.coalesce(changed, text) if c == text_col else F.col(n)).alias(c) for c, n in own.items()], kinds.alias("entities"))
