"""Operator 7: surrogates for personal data (DataFrame functions only).

Detected entities are replaced by keyed surrogates of the same type and
format: digits for digits, letters for letters of the same case, hex for hex;
card numbers keep the first digit and, where it holds, the Luhn check; IPv4
addresses stay valid; mail addresses move to a reserved domain; names keep the
gender of their title and their script. Spaces and punctuation inside an
entity stay as they are.

Names are found after a title. The given and family names so found in a
document are replaced wherever else they stand there as capitalised words of
their own, without a title too. A mail address ``given.family@`` also names a
person if the document has both words, capitalised, one after the other. A
word known as given and as family name counts as given name.

Mentions are matched to an entity by a canonical form (no separators, mail in
lower case, given and family names apart), so one entity has one surrogate
throughout the corpus, however it is written. Surrogates depend on the key,
the type, the canonical form and an attempt number. Entities whose surrogate
is also another's, or is any entity's own text, try again with the next
number, until none is left: different entities stay different. From attempt
``FIXED_LENGTH`` on each attempt is a character longer (a syllable in names
from the first), so entities of a shape may outnumber the surrogates of that
shape: what finds no room keeps its type and becomes longer.

Texts are searched once and staged with their mentions. Only documents with
entities, a small part, take part in exchanges. A hot entity is one row on
the side of the surrogates, so Spark can split its mentions.

``docs`` must be a plain scan. Defined cases: null and empty texts stay as
they are; equal texts get equal replacements; repeated rows are replaced one
by one; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, staged, with_row_id

# Titles by gender, and the patterns of the entity types, the
# first that fits a mention being its type.
MALE = "Mr Herr Monsieur Señor Sr Signor господин г-н Κύριος".split()
FEMALE = "Mrs Ms Miss Frau Madame Mme Señora Sra Signora госпожа г-жа Κυρία".split()
NEUTRAL = "Dr Prof".split()
_TITLES = "|".join([*FEMALE, *MALE, *NEUTRAL])
_TITLE = rf"(?:(?:{_TITLES})\.? ){{1,4}}"
TYPES = {
    "secret": r"(?<![0-9A-Za-z])(?:[0-9a-f]{32,128}|[0-9A-F]{32,128}|AKIA[0-9A-Z]{16}|gh[pousr]_[0-9A-Za-z]{36}|sk-[0-9A-Za-z]{20,100})(?![0-9A-Za-z])",
    "email": r"(?<![\p{L}0-9._%+-])[\p{L}0-9_%+-][\p{L}0-9._%+-]{0,63}@(?:[0-9A-Za-z-]{1,63}\.){1,8}[A-Za-z]{2,24}(?![0-9A-Za-z-])",
    "iban": r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?: ?[0-9A-Z]{4}){3,7}(?: ?[0-9A-Z]{1,3})?(?![0-9A-Za-z])",
    "ip": r"(?<![0-9.])(?:(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?![0-9]|\.[0-9])",
    "card": r"(?<![0-9-])(?:[0-9]{4}(?:[ -]?[0-9]{4}){3}|3[47][0-9]{2}[ -]?[0-9]{6}[ -]?[0-9]{5}|[0-9]{13,19})(?![0-9])",
    "phone": r"(?<![0-9])(?:\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)|[0-9]{1,4})(?:[ .-]?[0-9]{2,4}){2,4}|\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}|[0-9]{3}[.-][0-9]{3}[.-][0-9]{4}|0[1-9][0-9]{1,3}[ /-][0-9]{6,8})(?![0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "name": r"(?<![\p{L}])" + _TITLE + r"\p{Lu}\p{Ll}+(?:-\p{Lu}\p{Ll}+)?(?: \p{Lu}\p{Ll}+(?:-\p{Lu}\p{Ll}+)?)?",
}
PATTERN = "|".join(TYPES.values())
#: What a text with an entity has at least.
_HINT = rf"[0-9@]|(?:{_TITLES})\.? \p{{Lu}}"
#: What stands around a name without a title.
_ALONE = r"(?<![\p{L}\p{M}0-9_])(?:", r")(?![\p{L}\p{M}0-9_])"
#: Attempts that keep the length of the entity.
FIXED_LENGTH = 3
#: Letters by class; those of other scripts and with accents take plain ones of their case.
LETTERS = (("[0-9]", "0123456789"), (r"[а-яёіїєґ]", "абвгдежзиклмнопрстуфхцч"), (r"[А-ЯЁІЇЄҐ]", "АБВГДЕЖЗИКЛМНОПРСТУФХЦЧ"),
           (r"[α-ωά-ώ]", "αβγδεζηθικλμνξοπρστυφχψω"), (r"[Α-ΩΆ-Ώ]", "ΑΒΓΔΕΖΗΘΙΚΛΜΝΞΟΠΡΣΤΥΦΧΨΩ"),
           (r"\p{Lu}", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"), (r"\p{L}", "abcdefghijklmnopqrstuvwxyz"))
SYLLABLES = {
    "latin": "ba be bo da de di do fa fe ga go ka ki la le li lo ma me mi mo na ne ni no pa pe ra re ri ro sa se so ta te ti to va ve vi".split(),
    "cyrillic": "ба бо ва ве ви га го да де ди ка ки ла ле ли ма ме ми на не ни па по ра ре ри са се со та те ти".split(),
    "greek": "βα βο γα δα δε δι κα κο λα λε λι μα με μι να νε νι πα πο ρα ρε ρι σα σε σο τα τε τι".split(),
}
ENDINGS = {"latin": {"m": "s", "f": "ra", "n": "l"}, "cyrillic": {"m": "н", "f": "на", "n": "ль"}, "greek": {"m": "ς", "f": "νη", "n": "λ"}}
FAMILY_ENDINGS = {"latin": "nt", "cyrillic": "енко", "greek": "ίδης"}


def _kind(mention: Column) -> Column:
    out = F.lit("name")
    for name, pattern in reversed(list(TYPES.items())[:-1]):
        out = F.when(mention.rlike(f"^(?:{pattern})$"), name).otherwise(out)
    return out


def _script(word: Column) -> Column:
    return F.when(word.rlike(r"\p{IsCyrillic}"), "cyrillic").when(word.rlike(r"\p{IsGreek}"), "greek").otherwise("latin")


def _parts(kind: Column, mention: Column) -> Column:
    """A mention as parts: kind, canonical form, text before it, its text."""
    def part(k, canon, lead, raw):
        return F.struct(k.alias("kind"), canon.alias("canon"), lead.alias("lead"), raw.alias("raw"))

    bare = F.regexp_replace(mention, r"[ ().-]", "")
    plain = F.when(kind == "email", F.lower(mention)).when(kind.isin("secret", "ip"), mention).otherwise(bare)
    title = F.regexp_extract(mention, "^" + _TITLE, 0)
    words = F.split(F.regexp_replace(mention, "^" + _TITLE, ""), " ")
    has = lambda titles: title.rlike("(?:^| )(?:" + "|".join(titles) + r")\.? ")
    gender = F.when(has(FEMALE), "f").when(has(MALE), "m").otherwise("n")
    family = F.element_at(words, -1)
    given = F.element_at(words, 1)
    of_name = F.when(F.size(words) == 1, F.array(part(F.concat(F.lit("family:"), _script(family)), F.lower(family), title, family))).otherwise(F.array(
        part(F.concat(F.lit("given:"), gender, F.lit(":"), _script(given)), F.lower(given), title, given),
        part(F.concat(F.lit("family:"), _script(family)), F.lower(family), F.lit(" "), family)))
    return F.when(kind == "name", of_name).otherwise(F.array(part(kind, plain, F.lit(""), mention)))


def _number(digest: Column, i: Column) -> Column:
    """A number under 65,536 for place i."""
    return F.conv(F.substring(digest, F.pmod(i * 3, F.lit(124)).cast("int") + 1, F.lit(4)), 16, 10).cast("int")


def _same_class(text: Column, digest: Column, keep: Column, secret: Column) -> Column:
    """Digits for digits, letters for letters of their case (in secrets hex
    for hex); the first ``keep`` characters stay."""
    hexed = F.when(secret & text.rlike("^[0-9a-f]+$"), "0123456789abcdef").when(secret & text.rlike("^[0-9A-F]+$") & text.rlike("[A-F]"), "0123456789ABCDEF")

    def one(c: Column, i: Column) -> Column:
        n = _number(digest, i)
        pick = lambda letters: F.substring(F.lit(letters), F.pmod(n, F.lit(len(letters))) + 1, F.lit(1))
        out = F.when(i < keep, c).when(hexed.isNotNull() & text.rlike("[a-fA-F]"), F.substring(hexed, F.pmod(n, F.lit(16)) + 1, F.lit(1)))
        for pattern, letters in LETTERS:
            out = out.when(c.rlike(pattern), pick(letters))
        return out.otherwise(c)
    return F.array_join(F.transform(F.filter(F.split(text, ""), lambda c: c != ""), one), "")


def _luhn(digits: Column) -> Column:
    """The Luhn sum modulo 10."""
    each = F.transform(F.filter(F.split(F.reverse(digits), ""), lambda c: c != ""), lambda c, i: F.when(
        i % 2 == 1, F.when(c.cast("int") > 4, c.cast("int") * 2 - 9).otherwise(c.cast("int") * 2)).otherwise(c.cast("int")))
    return F.aggregate(each, F.lit(0), lambda a, b: a + b) % 10


def _surrogate(kind: Column, canon: Column, attempt: Column, key: str) -> Column:
    digest = F.sha2(F.concat_ws("\x1f", F.lit(key), kind, canon, attempt.cast("string")).cast("binary"), 512)

    def of(h: Column) -> Column:
        more = F.greatest(attempt.cast("int") - F.lit(FIXED_LENGTH - 1), F.lit(0))
        longer = lambda c: _same_class(F.repeat(F.lit(c), more), F.reverse(h), F.lit(0), F.lit(False))
        swapped = lambda keep: _same_class(canon, h, keep, kind == "secret")
        n = F.length(canon)
        card = let(swapped(F.lit(1)), lambda s: F.when(_luhn(canon) != 0, s).otherwise(let(
            F.concat(F.substring(s, F.lit(1), n - 1), F.lit("0")), lambda z: F.concat(
                F.substring(z, F.lit(1), n - 1), F.pmod(10 - _luhn(z), F.lit(10)).cast("string")))))
        octets = F.array_join(F.transform(F.array(*[F.lit(i) for i in range(4)]), lambda i: (F.pmod(_number(h, i), F.lit(254)) + 1).cast("string")), ".")
        domain = F.concat(_same_class(F.regexp_extract(canon, "@([^.]+)", 1), F.reverse(h), F.lit(0), F.lit(False)), F.lit(".example."),
                          F.element_at(F.array(F.lit("com"), F.lit("net"), F.lit("org")), F.pmod(_number(h, F.lit(40)), F.lit(3)) + 1))
        mail = F.concat(_same_class(F.regexp_extract(canon, "^([^@]+)", 1), h, F.lit(0), F.lit(False)), longer("a"), F.lit("@"), domain)

        def name(script: str, ending: Column) -> Column:
            parts = SYLLABLES[script]
            count = F.lit(3).cast("int") + attempt.cast("int")  # each attempt is a syllable longer: room for any number of names
            return F.initcap(F.concat(F.array_join(F.transform(F.sequence(F.lit(1), count), lambda i: F.element_at(
                F.array(*map(F.lit, parts)), F.pmod(_number(h, i), F.lit(len(parts))) + 1)), ""), ending))

        out = F.when(kind == "email", mail)
        for script in SYLLABLES:
            for gender, ending in ENDINGS[script].items():
                out = out.when(kind == f"given:{gender}:{script}", name(script, F.lit(ending)))
            out = out.when(kind == f"family:{script}", name(script, F.lit(FAMILY_ENDINGS[script])))
        return out.otherwise(F.concat(
            F.when(kind == "ip", octets).when(kind == "card", card).when(((kind == "phone") & canon.startswith("+")) | (kind == "iban"), swapped(F.lit(2)))
            .otherwise(swapped(F.lit(0))), longer("0")))
    return let(digest, of)


def surrogates(entities: DataFrame, key: str) -> DataFrame:
    """(kind, canon, surrogate) for distinct (kind, canon): one-to-one within
    a kind, and no surrogate is any entity's own canonical form."""
    base = staged(entities.select("kind", "canon").distinct(), "pii-entities")
    own = base.select("kind", F.col("canon").alias("own"))
    form = F.when(F.col("kind").rlike("^(given|family)"), F.lower("surrogate")).otherwise(F.col("surrogate"))
    todo, attempt, parts = base, 0, []
    while True:
        made = todo.withColumn("surrogate", _surrogate(F.col("kind"), F.col("canon"), F.lit(attempt), key)).withColumn("own", form)
        made = made.join(own, ["kind", "own"], "left_anti")
        first = made.groupBy("kind", "own").agg(F.min(F.struct("canon", "surrogate")).alias("x")).select("kind", "own", "x.*")
        for part in parts:
            first = first.join(part.select("kind", "own"), ["kind", "own"], "left_anti")
        parts.append(staged(first.select("kind", "canon", "surrogate", "own"), "pii-surrogates"))
        todo = staged(todo.join(parts[-1], ["kind", "canon"], "left_anti"), "pii-open")
        if todo.isEmpty():
            return reduce(DataFrame.union, parts).select("kind", "canon", "surrogate")
        attempt += 1


def _rendered(kind: Column, raw: Column, surrogate: Column) -> Column:
    """The surrogate in the mention's own format: its characters take the
    places of the mention's, separators stay."""
    spaced = raw.rlike(r"[ ().-]") & kind.isin("card", "phone", "ssn", "iban")
    slots = F.filter(F.split(raw, ""), lambda c: c != "")

    def placed(s: Column) -> Column:
        return F.aggregate(slots, F.struct(F.lit("").alias("out"), F.lit(1).alias("at")), lambda acc, c: F.when(
            c.rlike(r"[ ().-]"), F.struct(F.concat(acc["out"], c).alias("out"), acc["at"].alias("at"))).otherwise(
            F.struct(F.concat(acc["out"], F.substring(s, acc["at"], F.lit(1))).alias("out"), (acc["at"] + 1).alias("at"))),
            lambda acc: F.concat(acc["out"], F.substring(s, acc["at"], F.length(s))))
    return F.when(spaced, let(surrogate, placed)).otherwise(surrogate)


def _known(text: Column, mentions: Column) -> Column:
    """The names that a document's mentions tell, longest first: arrays of
    word, kind and canonical form."""
    def word(w: Column, kind: Column, canon: Column) -> Column:
        return F.struct((-F.length(w)).alias("rank"), w.alias("word"), kind.alias("kind"), canon.alias("canon"))

    titled = F.flatten(F.transform(F.filter(mentions, lambda m: m.rlike("^" + _TITLE)), lambda m: F.transform(
        _parts(F.lit("name"), m), lambda p: word(p["raw"], p["kind"], p["canon"]))))

    def person(mail: Column) -> Column:
        words = F.transform(F.filter(F.split(F.lower(F.substring_index(mail, "@", 1)), r"[0-9._%+-]+"), lambda w: F.length(w) > 1), F.initcap)
        given, family = F.get(words, F.lit(0)), F.get(words, F.size(words) - 1)
        return F.when((F.size(words) > 1) & text.contains(F.concat_ws(" ", given, family)), F.array(
            word(given, F.concat(F.lit("given:n:"), _script(given)), F.lower(given)),
            word(family, F.concat(F.lit("family:"), _script(family)), F.lower(family)))).otherwise(F.slice(titled_type, 1, 0))

    titled_type = F.array(word(F.lit(""), F.lit(""), F.lit("")))
    mailed = F.flatten(F.transform(F.filter(mentions, lambda m: m.contains("@")), person))
    return F.array_sort(F.array_union(titled, F.filter(mailed, lambda k: ~F.exists(titled, lambda t: t["word"] == k["word"]))))


def pseudonymise(docs: DataFrame, secret: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: doc_id, text with surrogates, n_replaced
    mentions."""
    rows = with_row_id(docs, "row").select("row", F.col(key).alias("doc_id"), F.col(text).alias("text"))
    hinted = F.coalesce(F.col("text").rlike(_HINT), F.lit(False))
    mentions = F.when(hinted, F.regexp_extract_all("text", F.lit(PATTERN), F.lit(0))).otherwise(F.array().cast("array<string>"))
    rows = staged(rows.withColumn("mentions", mentions), "pii-documents")
    some = F.size("mentions") > 0
    none = rows.where(~some).select("doc_id", "text", F.lit(0).cast("long").alias("n_replaced"))
    found = rows.where(some).withColumn("known", _known(F.col("text"), F.col("mentions")))
    bare = F.concat(F.lit("|" + _ALONE[0]), F.array_join(F.transform("known", lambda k: k["word"]), "|"), F.lit(_ALONE[1]))
    found = found.withColumn("bare", F.when(F.size("known") > 0, bare).otherwise(""))
    pattern = F.concat(F.lit(PATTERN), F.col("bare"))
    found = staged(found.withColumn("mentions", F.when(F.size("known") > 0, F.regexp_extract_all("text", pattern, F.lit(0))).otherwise(F.col("mentions"))),
                   "pii-found")

    def parts_of(m: Column) -> Column:
        alone = F.get(F.reverse(F.filter("known", lambda k: k["word"] == m)), F.lit(0))
        return let(alone, lambda k: F.when(k["word"].isNotNull(), F.array(F.struct(
            k["kind"].alias("kind"), k["canon"].alias("canon"), F.lit("").alias("lead"), m.alias("raw")))).otherwise(_parts(_kind(m), m)))

    each = found.select("row", F.posexplode(F.transform("mentions", parts_of)).alias("pos", "parts"))
    each = staged(each.select("row", "pos", F.posexplode("parts").alias("nth", "part")).select("row", "pos", "nth", "part.*"), "pii-mentions")
    made = each.join(surrogates(each, secret), ["kind", "canon"])
    said = made.select("row", "pos", "nth", F.concat("lead", _rendered(F.col("kind"), F.col("raw"), F.col("surrogate"))).alias("said"))
    said = said.groupBy("row", "pos").agg(F.sort_array(F.collect_list(F.struct("nth", "said"))).alias("s"))
    said = said.select("row", "pos", F.array_join(F.transform("s", lambda x: x["said"]), "").alias("said"))
    said = said.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("pos", "said"))).alias("s"))
    parts = F.split(F.col("text"), pattern, -1)
    whole = let(F.transform("s", lambda x: x["said"]), lambda s: F.array_join(
        F.transform(parts, lambda p, i: F.concat(p, F.coalesce(F.get(s, i), F.lit("")))), ""))
    changed = found.drop("known").join(said, "row").select("doc_id", whole.alias("text"), F.size("mentions").cast("long").alias("n_replaced"))
    return none.unionByName(changed)
