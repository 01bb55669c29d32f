"""Surrogates for personal data, in DataFrame functions alone.

One pattern finds mentions of all kinds; cards must pass the Luhn check, and what
stands behind the word of a secret is a secret whatever its shape.  The
distinct mentions of the corpus are cut into entities (a person's given name
and surname are entities of their own, so later mentions by surname agree, with a
form of address or bare in the same text; a bare word is one mention).  Dr and Prof
take the gender that gendered mentions of the name agree on, else a neutral name.
The README says which names are not found.  Every entity gets a surrogate from a
keyed hash: digits for digits, letters of the same case and script for letters,
punctuation kept, cards with a valid check digit and their first digit, account
numbers (IBAN) with their country and its check digits, addresses (IP) of the same
class (private, loopback, link-local or public), given names with the ending of their
gender, mail addresses of one domain on one surrogate domain and the same top level.  The
same entity always gets the same surrogate.  Surrogates of one kind that meet
each other, or an original of the corpus, are drawn again with the next attempt
number until all are distinct; earlier attempts keep theirs.  An entity whose
format has no free value after ``CROWDED`` attempts gets eight more digits.

Texts without a digit, ``@``, form of address, word before a secret or 32
hexadecimal letters cannot hold a mention; they pass through unshuffled.  The others are shuffled once, with the mentions of their own
text.  Distinct entities are aggregated before any shuffle, and the joins with
them have one row per mention on the small side, so a mention found in a third of
all texts is split like any skewed join.

Defined results: null text stays null and empty text empty, without entities; a
row's result depends on its text and the corpus only, so rows with equal or null
ids are worked one by one; an empty table stays empty.  Other columns pass
through unless they have the name of a result column, which then replaces them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage, free_names

# Forms of address by gender (fixed values).
FEMALE = ("Mrs", "Ms", "Miss", "Frau", "Señora", "Sra", "Madame", "Mme", "Mademoiselle", "Г-жа", "Госпожа", "Κυρία")
MALE = ("Mr", "Herr", "Señor", "Sr", "Monsieur", "Г-н", "Господин", "Κύριος")
EITHER = ("Dr", "Prof")
_ADDRESS = rf"(?:{'|'.join(sorted((*FEMALE, *MALE, *EITHER), key=len, reverse=True))})\.?"
_NAME = r"\p{Lu}[\p{Ll}]+(?:-\p{Lu}\p{Ll}+)?"
# Letters that a name or form of address could go on with; text without blanks has letters of other scripts right beside them.
_LETTER = r"[\p{IsLatin}\p{IsGreek}\p{IsCyrillic}]"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"

# Kind and pattern of a whole mention, in the order in which they are tried.
KINDS = (
    ("email", r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[\p{L}\p{N}-]+(?:\.[\p{L}\p{N}-]+)*\.\p{L}{2,}"),
    ("secret", r"(?=[\w+/=.-]{12})(?<=(?i:token|secret|password|passwd|api[_-]?key|access[_-]?key)\"?\s{0,3}[=:]\s{0,3}[\"']?)([\w+/=.-]{12,})"),
    ("secret", r"(?<![\w])[0-9a-fA-F]{32,128}(?![\w])"),
    ("iban", r"(?<![\w])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![\w])"),
    ("phone", r"(?<![\w+])\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,4}(?![\w])"),
    ("phone", r"(?<![\w])\(\d{3}\) ?\d{3}[ .-]\d{4}(?![\w])"),
    ("phone", r"(?<![\w.-])\d{3}[.-]\d{3}[.-]\d{4}(?![\w])"),
    ("card", r"(?<![\w.-])\d(?:[ -]?\d){12,18}(?![\w])"),
    ("ssn", r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])"),
    ("ip", rf"(?<![\w.])(?<!(?i:version|release|ver)[ .]{{1,2}})(?:{_OCTET}\.){{3}}{_OCTET}(?!\.?\d|\w)"),
    ("person", rf"(?=[MFSDPHГΚ])(?<!{_LETTER}|[\p{{N}}_]){_ADDRESS} {_NAME}(?: {_NAME})?(?!{_LETTER})"),
)
BARE = rf"(?<!{_LETTER}|[\p{{N}}_]){_NAME}(?!{_LETTER})"  # a word that may be a name without its form of address
# No mention starts behind an ASCII letter, digit or _; this is looked at first, so most places cost one step.  The one group
# is a secret known by the word before it.
MENTION = rf"(?<![A-Za-z0-9_])(?:{'|'.join(f'(?:{p})' for _, p in KINDS)})"
# What every mention holds one of: a digit, @ or 32 hexadecimal letters, the start of an address, a word before a secret in any case.
MAY_HOLD = "[0-9@]|[a-fA-F]{32}"
MAY_START = ("Mr", "Ms", "Miss", "Mme", "Mad", "Monsieur", "Frau", "Herr", "Señor", "Sr", "Dr", "Prof", "Г-", "Госпо", "Κυρί", "Κύρι")
SECRET_WORDS = ("token", "secret", "password", "passwd", "api", "access")
# Letters to draw from, by script (fixed values: the lower case, or common letters where a script has no case).
LOWER = {"latin": "abcdefghijklmnopqrstuvwxyz", "cyrillic": "абвгдежзиклмнопрстуфхцчшэюя", "greek": "αβγδεζηθικλμνξοπρστυφχψω",
         "armenian": "աբգդեզէըթժիլխծկհձղճմյնշոչպջռսվտրցփքօֆ", "georgian": "აბგდევზთიკლმნოპჟრსტუფქღყშჩცძწჭხჯჰ", "hebrew": "אבגדהוזחטיכלמנסעפצקרשת",
         "arabic": "ابتثجحخدذرزسشصضطظعغفقكلمنهوي", "devanagari": "कखगघचछजझटठडढतथदधनपफबभमयरलवशषसह", "thai": "กขคงจฉชซญดตถทธนบปผพฟภมยรลวศสหอ",
         "hangul": "가나다라마바사아자차카타파하고노도로모보소오조초코토포호", "hiragana": "あいうえおかきくけこさしすせそたちつてとなにぬねの",
         "katakana": "アイウエオカキクケコサシスセソタチツテトナニヌネノ", "han": "一二三四五六七八九十人口日月山水火木金土"}
CROWDED = 12
VOWELS = {"latin": "aeiou", "cyrillic": "аеиоу", "greek": "αεηιο"}
CONSONANTS = {"latin": "bdfghklmnprstvz", "cyrillic": "бвгдзклмнпрстфх", "greek": "βγδζθκλμνπρστφχ"}
ENDING = {("latin", "f"): "a", ("latin", "m"): "n", ("cyrillic", "f"): "а", ("cyrillic", "m"): "н",
          ("greek", "f"): "α", ("greek", "m"): "ς"}


def _byte(hexes: Column, i: Column) -> Column:
    """The i-th byte (from 0, around) of the 128 bytes that 256 hexadecimal digits are."""
    return F.conv(F.substr(hexes, F.lit(1) + 2 * F.pmod(i, F.lit(128)), F.lit(2)), 16, 10).cast("int")


def _pick(letters: str, n: Column) -> Column:
    return F.substr(F.lit(letters), F.lit(1) + F.pmod(n, F.lit(len(letters))), F.lit(1))


def _stream(key: str, *parts: Column) -> Column:
    """256 hexadecimal digits of a keyed hash."""
    text = F.concat_ws("\0", *parts)
    once = lambda i: F.sha2(F.concat(F.lit(f"{key}\0{i}\0"), F.sha2(F.concat(F.lit(f"{key}\1"), text), 256)), 256)
    return F.concat(*(once(i) for i in range(4)))


def _shaped(value: Column, hexes: Column) -> Column:
    """``value`` with every digit and letter drawn anew, in its own case and script."""
    def one(i: Column) -> Column:
        c, b = F.substr(value, i, F.lit(1)), _byte(hexes, i)
        small = F.lower(c)
        drawn = F.when(small.between("a", "z"), _pick(LOWER["latin"], b))
        for script, letters in LOWER.items():
            drawn = drawn.when(small.rlike(rf"^\p{{Is{script.title()}}}"), _pick(letters, b))
        drawn = drawn.otherwise(_pick(LOWER["latin"], b))
        return (F.when(c.rlike("^[0-9]"), F.pmod(b, F.lit(10)).cast("string"))
                .when(c.rlike(r"^\p{Lu}"), F.upper(drawn)).when(c.rlike(r"^\p{L}"), drawn).otherwise(c))
    return F.array_join(F.transform(F.sequence(F.lit(1), F.greatest(F.length(value), F.lit(1))), one), "")


def _name(kind: Column, script: str, hexes: Column) -> Column:
    """Three or four syllables; given names end by gender, surnames and given names of no known gender on a consonant."""
    syllable = lambda i: F.concat(_pick(CONSONANTS[script], _byte(hexes, F.lit(2 * i))),
                                  _pick(VOWELS[script], _byte(hexes, F.lit(2 * i + 1))))
    stem = F.concat(syllable(0), syllable(1), F.when(_byte(hexes, F.lit(20)) % 2 == 0, syllable(2)).otherwise(F.lit("")))
    last = _pick(CONSONANTS[script], _byte(hexes, F.lit(21)))
    ending = (F.when(kind == "given_f", F.concat(last, F.lit(ENDING[script, "f"])))
              .when(kind == "given_m", F.concat(last, F.lit(VOWELS[script][3]), F.lit(ENDING[script, "m"])))
              .otherwise(F.concat(syllable(3), last)))
    return F.initcap(F.concat(stem, ending))


def _iban(value: Column, shaped: Column) -> Column:
    """Country of ``value``, the check digits that fit, the rest of ``shaped``."""
    country, rest = F.substr(value, F.lit(1), F.lit(2)), F.substr(shaped, F.lit(5))
    letters = F.filter(F.split(F.concat(F.replace(rest, F.lit(" "), F.lit("")), country, F.lit("00")), ""), lambda c: c != "")
    left = F.aggregate(letters, F.lit(0), lambda n, c: F.when(c.between("0", "9"), (n * 10 + F.ascii(c) - 48) % 97).otherwise(
        (n * 100 + F.ascii(c) - 55) % 97))  # A counts as 10
    return F.concat(country, F.lpad((98 - left).cast("string"), 2, "0"), rest)


def _ip(value: Column, hexes: Column) -> Column:
    """Another address of the class of ``value``."""
    byte = [_byte(hexes, F.lit(i)) for i in range(4)]
    dotted = lambda *parts: F.concat_ws(".", *[p if isinstance(p, Column) else F.lit(p) for p in parts])
    return (F.when(value.rlike(r"^(10|127)\."), dotted(F.regexp_extract(value, r"^\d+", 0), *byte[1:]))
            .when(value.rlike(r"^(192\.168|169\.254)\."), dotted(F.regexp_extract(value, r"^\d+\.\d+", 0), *byte[2:]))
            .when(value.rlike(r"^172\.(1[6-9]|2\d|3[01])\."), dotted("172", (16 + F.pmod(byte[1], F.lit(16))).cast("string"), *byte[2:]))
            .otherwise(dotted((11 + F.pmod(byte[0], F.lit(89))).cast("string"), *byte[1:])))


def with_surrogate(entities: DataFrame, key: str) -> DataFrame:
    """Entity rows ``kind, value, attempt`` with their ``surrogate``; each step is a column of its own."""
    kind, value, hexes, shaped = F.col("kind"), F.col("value"), F.col("hexes"), F.col("shaped")
    prefix = F.regexp_extract(value, r"^(\+\d{1,3})?", 0)
    rows = entities.select(
        "kind", "value", "attempt", _stream(key, kind, value, F.col("attempt").cast("string")).alias("hexes"),
        F.regexp_extract(value, r"^([^@]*)@", 1).alias("local"), F.regexp_extract(value, r"@(.*)\.[^.]*$", 1).alias("domain"))
    rows = rows.withColumn("domain_hexes", _stream(key, F.lit("domain"), F.col("domain")))
    rows = rows.withColumn("shaped", F.when(kind == "email", F.concat(
        _shaped(F.col("local"), hexes), F.lit("@"), _shaped(F.col("domain"), F.col("domain_hexes")),
        F.regexp_extract(value, r"(\.[^.]*)$", 1))).otherwise(_shaped(value, hexes)))
    rows = rows.withColumn("body", F.concat(F.substr(value, F.lit(1), F.lit(1)), F.substr(shaped, F.lit(2), F.length(value) - 2)))
    digits = F.transform(F.sequence(F.lit(0), F.lit(9)), lambda d: d.cast("string"))
    valid = F.filter(digits, lambda d: F.call_function("luhn_check", F.regexp_replace(F.concat(F.col("body"), d), "[ -]", "")))
    hexed = F.array_join(F.transform(F.sequence(F.lit(1), F.length(value)), lambda i: F.substr(
        hexes, F.lit(1) + F.pmod(i, F.lit(256)), F.lit(1))), "")
    name = F.when(value.rlike(r"^\p{IsCyrillic}"), _name(kind, "cyrillic", hexes)).when(
        value.rlike(r"^\p{IsGreek}"), _name(kind, "greek", hexes)).otherwise(_name(kind, "latin", hexes))
    drawn = (F.when(kind == "ip", _ip(value, hexes)).when(kind == "iban", _iban(value, shaped)).when(kind == "card", F.concat(F.col("body"), F.element_at(valid, 1)))
             .when(kind == "phone", F.concat(prefix, F.substr(shaped, F.length(prefix) + 1, F.length(value))))
             .when((kind == "secret") & value.rlike("^[0-9a-f]+$"), hexed)
             .when((kind == "secret") & value.rlike("^[0-9A-F]+$"), F.upper(hexed))
             .when(kind.isin("given_f", "given_m", "given_n", "surname"), name).otherwise(shaped))
    crowded = F.when(F.col("attempt") >= CROWDED, F.substr(F.conv(F.substr(hexes, F.lit(1), F.lit(12)), 16, 10), F.lit(1), F.lit(8)))
    return rows.select("kind", "value", "attempt", F.concat(drawn, F.coalesce(crowded, F.lit(""))).alias("surrogate"))


def _found(text: Column) -> Column:
    """All mentions of a text in order; one behind the word of a secret has ``=`` put before it, which starts no other."""
    found, secrets = (F.regexp_extract_all(text, F.lit(MENTION), F.lit(i)) for i in (0, 1))
    marked = F.zip_with(found, secrets, lambda m, secret: F.when(secret != "", F.concat(F.lit("="), secret)).otherwise(m))
    return F.when(_holds(F.lower(text), SECRET_WORDS), marked).otherwise(found)


def _kind_of(mention: Column) -> Column:
    found = F.when(mention.startswith("="), "secret").when(mention.rlike(rf"^(?:{KINDS[0][1]})$"), "email")
    for kind, pattern in KINDS[2:]:
        yes = mention.rlike(rf"^(?:{pattern})$")
        if kind == "card":
            found = found.when(yes, F.when(F.call_function("luhn_check", F.regexp_replace(mention, "[ -]", "")), "card"))
        else:
            found = found.when(yes, kind)
    return found.otherwise("secret")


def _words(mention: Column) -> Column:
    return F.split(F.regexp_replace(mention, rf"^{_ADDRESS} ", ""), " ")


def _with_gender(kinds: DataFrame) -> DataFrame:
    """``kinds`` with the ``gender`` (f, m or n) of each person's given name.  Forms of address of either gender take it from
    the gendered mentions of the same given name and surname, else of the same given name, where those agree."""
    words = _words(F.col("mention"))
    said = F.when(F.col("mention").rlike(rf"^(?:{'|'.join(FEMALE)})\.? "), "f").when(
        F.col("mention").rlike(rf"^(?:{'|'.join(MALE)})\.? "), "m")
    full = (F.col("kind") == "person") & (F.size(words) > 1)
    gendered = kinds.where(full & said.isNotNull()).select(words[0].alias("given"), words[1].alias("surname"), said.alias("gender"))

    def agreed(name: str, *by: str) -> DataFrame:
        seen = gendered.groupBy(*by).agg(F.min("gender").alias(name), F.max("gender").alias("other"))
        return seen.where(F.col(name) == F.col("other")).drop("other")

    open_ = full & said.isNull()
    asked = kinds.where(open_).withColumn("given", words[0]).withColumn("surname", words[1])
    told = (asked.join(agreed("of_full", "given", "surname"), ["given", "surname"], "left").join(agreed("of_given", "given"), ["given"], "left")
            .select("mention", "kind", F.coalesce("of_full", "of_given", F.lit("n")).alias("gender")))
    return kinds.where(~open_).withColumn("gender", F.coalesce(said, F.lit("n"))).unionByName(told)


def _entities(mention: Column, kind: Column, gender: Column) -> Column:
    """``array<struct<kind, value>>`` of a mention, in the order of its text."""
    words = _words(mention)
    person = F.transform(words, lambda w, i: F.struct(
        F.when(i == F.size(words) - 1, "surname").otherwise(F.concat(F.lit("given_"), gender)).alias("kind"), w.alias("value")))
    value = F.when(kind == "email", F.lower(mention)).when(mention.startswith("="), F.substr(mention, F.lit(2))).otherwise(mention)
    plain = F.array(F.struct(kind.alias("kind"), value.alias("value")))
    return F.when(kind == "person", person).otherwise(plain)


def _names_of_text(names: Column) -> Column:
    """``map<name, surrogate>`` of a text's name parts; a word that is both is a surname, then a given name of known gender."""
    names = F.array_sort(F.flatten(names))
    first = F.filter(names, lambda n, i: (i == 0) | (F.get(names, i - 1)["value"] != n["value"]))
    return F.map_from_entries(F.transform(first, lambda n: F.struct(n["value"], n["surrogate"])))


def _said(names: Column, word: Column) -> Column:
    """A capitalised word, or each side of its hyphen, by the names of its text."""
    return F.coalesce(names[word], F.array_join(F.transform(F.split(word, "-"), lambda w: F.coalesce(names[w], w)), "-"))


def _bare(gap: Column) -> Column:
    return F.regexp_extract_all(gap, F.lit(BARE), F.lit(0))


def draw(entities: DataFrame, key: str) -> DataFrame:
    """``kind, value, surrogate``: distinct surrogates for distinct entities, none of them an original of its kind."""
    fixed = cut_lineage(with_surrogate(entities.withColumn("attempt", F.lit(0)), key))
    originals = entities.select("kind", F.col("value").alias("surrogate"), F.lit(True).alias("original"))
    while True:
        keeper = fixed.groupBy("kind", "surrogate").agg(F.min(F.struct("attempt", "value")).alias("keeper"))
        judged = (fixed.join(keeper, ["kind", "surrogate"]).join(originals, ["kind", "surrogate"], "left")
                  .withColumn("again", F.col("original").isNotNull() | (F.col("keeper.value") != F.col("value"))))
        if not judged.where("again").limit(1).count():
            return fixed.select("kind", "value", "surrogate")
        drawn = with_surrogate(judged.where("again").select("kind", "value", (F.col("attempt") + 1).alias("attempt")), key)
        fixed = cut_lineage(judged.where("not again").select(*drawn.columns).unionByName(drawn))


def _holds(text: Column, words: tuple[str, ...]) -> Column:
    return reduce(lambda a, b: a | b, (F.contains(text, F.lit(w)) for w in words))


def may_mention(text: Column) -> Column:
    """False only for a text in which ``MENTION`` finds nothing."""
    return F.coalesce(text.rlike(MAY_HOLD) | _holds(text, MAY_START) | _holds(F.lower(text), SECRET_WORDS), F.lit(False))


def replace_entities(docs: DataFrame, key: str) -> DataFrame:
    """The rows of ``docs`` with surrogates in ``text``, and ``n_entities``, the mentions replaced."""
    docs = docs.drop("n_entities").withColumn("text", F.col("text").cast("string"))
    of, text_hash, known_, names_, found_, gaps_, its_id, its_text = free_names(docs, "of", "hash", "known", "names", "found", "gaps", "of_id", "of_text")
    may = may_mention(F.col("text"))
    id_of = F.coalesce(F.concat(F.lit("="), F.col("doc_id").cast("string")), F.lit(""))
    keyed = docs.where(may).withColumn(of, id_of).withColumn(text_hash, F.xxhash64("text"))
    # the mentions of a text are looked for once and written
    scanned = cut_lineage(keyed.select(F.col(of).alias("of_id"), F.col(text_hash).alias("of_text"), _found(F.col("text")).alias("found"))
                          .where(F.size("found") > 0)).dropDuplicates(["of_id", "of_text"])
    mentions = scanned.select("of_id", "of_text", F.explode(F.array_distinct("found")).alias("mention"))
    kinds = cut_lineage(mentions.select("mention").distinct().withColumn("kind", _kind_of(F.col("mention"))).where("kind is not null"))
    kinds = cut_lineage(_with_gender(kinds).withColumn("parts", _entities(F.col("mention"), F.col("kind"), F.col("gender"))))
    parts = kinds.select("mention", "kind", F.posexplode("parts").alias("pos", "part")).select(
        "mention", F.col("kind").alias("of"), "pos", "part.kind", "part.value")
    drawn = draw(cut_lineage(parts.select("kind", "value").distinct()), key)
    address = F.regexp_extract("mention", rf"^{_ADDRESS} ", 0)
    words = F.array_join(F.transform("said", lambda p: p["surrogate"]), " ")
    rank = lambda p: F.when(p["kind"] == "surname", 0).when(p["kind"] == "given_n", 2).otherwise(1)
    names = F.transform("said", lambda p: F.struct(p["value"].alias("value"), rank(p).alias("rank"), p["surrogate"].alias("surrogate")))
    person = F.col("of") == "person"
    surrogates = cut_lineage(
        parts.join(drawn, ["kind", "value"]).groupBy("mention", "of")
        .agg(F.sort_array(F.collect_list(F.struct("pos", "kind", "value", "surrogate"))).alias("said"))
        .select("mention", F.concat(F.when(person, address).otherwise(""), words).alias("surrogate"), F.when(person, names).alias("names")))
    of_text = (mentions.join(surrogates, "mention").groupBy("of_id", "of_text")
               .agg(F.map_from_entries(F.collect_set(F.struct("mention", "surrogate"))).alias(known_),
                    _names_of_text(F.collect_set("names")).alias(names_)))
    of_text = scanned.join(of_text, ["of_id", "of_text"]).withColumnsRenamed({"found": found_, "of_id": its_id, "of_text": its_text})
    held = keyed.join(of_text, (F.col(of) == F.col(its_id)) & (F.col(text_hash) == F.col(its_text)), "left").select(
        *docs.columns, known_, names_, found_).withColumn(gaps_, F.when(F.col(known_).isNotNull(), F.split("text", MENTION, -1)))
    known, names, found, gaps = F.col(known_), F.col(names_), F.col(found_), F.col(gaps_)
    named = F.transform(gaps, lambda gap: F.array_join(F.zip_with(
        F.split(gap, BARE, -1), _bare(gap), lambda g, w: F.concat(g, F.coalesce(_said(names, w), F.lit("")))), ""))
    n_named = F.aggregate(gaps, F.lit(0), lambda n, gap: n + F.size(F.filter(_bare(gap), lambda w: _said(names, w) != w)))
    has = F.size(names) > 0
    pieces = F.zip_with(F.when(has, named).otherwise(gaps), found, lambda gap, m: F.concat(gap, F.coalesce(known[m], m, F.lit(""))))
    n = (F.size(F.filter(found, lambda m: F.map_contains_key(known, m))) + F.when(has, n_named).otherwise(0)).cast("long")
    replaced = held.withColumn("n_entities", F.when(known.isNull(), F.lit(0).cast("long")).otherwise(n)).withColumn(
        "text", F.when(known.isNull(), F.col("text")).otherwise(F.array_join(pieces, ""))).drop(known_, names_, found_, gaps_)
    return docs.where(~may).withColumn("n_entities", F.lit(0).cast("long")).unionByName(replaced)
