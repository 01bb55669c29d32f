import re
from collections import Counter

import pytest
from llm.surrogates import EITHER, FEMALE, MALE, MENTION, draw, may_mention, replace_entities
from pyspark.sql import functions as F

KEY = "k"
TEXTS = {
    1: "Write to Anna.B@mail7.example.com, call +1 (184) 555-7766 from 43.21.141.162 now.",
    2: "card 4111 1111 1111 1111 and 4845168114407329; not 4845168114407321, order 1234567890123456",
    3: 'token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" end 04DBEBAB91AB85687D33EEAAF9AC699E1188F962!!',
    4: "Mrs. Anna Smith met Mr. John Smith. Mrs. Smith left; Herr Müller stayed. Dr. Ann-Marie Jones",
    5: "anna.b@mail7.example.com and 43.21.141.162 again; 300.1.1.1 is no address, v1.2.3 neither",
    6: "clean text without any of it", 7: None, 8: "", 9: "Госпожа Анна Петрова и Г-н Иван Петров; Κυρία Μαρία",
    10: "3.14 is 2024-01-02 and 12:30, 100000, a@b", 11: "SSN 123-45-6789 (212) 555-0100 DE89370400440532013000",
    12: "x" * 100_000 + " me@x.org " + "y " * 100_000, 13: "password: hunter2hunter2 $1 \\1 +49 30 901820",
}


def luhn(s):
    d = [int(c) for c in s if c.isdigit()][::-1]
    return (sum(d[::2]) + sum(sum(divmod(2 * x, 10)) for x in d[1::2])) % 10 == 0


@pytest.fixture(scope="module")
def out(spark):
    rows = [(i, t, 0, "k") for i, t in TEXTS.items()] + [(None, TEXTS[1], 0, "k"), (None, "me@x.org", 0, "k"), (1, TEXTS[1], 0, "k")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_entities int, mention string").repartition(2)
    return replace_entities(df, KEY).collect()


def text(out, i):
    return next(r.text for r in out if r.doc_id == i)


def test_rows_and_clean_texts(out):
    assert Counter(r.doc_id for r in out) == Counter([*TEXTS, None, None, 1])
    for i in (6, 7, 8, 10):
        assert text(out, i) == TEXTS[i]
    assert {r.doc_id: r.n_entities for r in out if r.doc_id} == {
        1: 3, 2: 2, 3: 2, 4: 5, 5: 2, 6: 0, 7: 0, 8: 0, 9: 3, 10: 0, 11: 3, 12: 1, 13: 2}


def test_originals_are_gone_and_formats_kept(out):
    t = text(out, 1)
    assert re.fullmatch(r"Write to [a-z]{4}\.[a-z]@[a-z]{4}\d\.[a-z]{7}\.com, call \+1 \(\d{3}\) \d{3}-\d{4} from \d+\.\d+\.\d+\.\d+ now\.", t)
    for gone in ("Anna", "7766", "43.21.141.162", "mail7"):
        assert gone not in t
    a, b, c, d = re.fullmatch(r"card (\d{4} \d{4} \d{4} \d{4}) and (\d{16}); not (\d{16}), order (\d+)", text(out, 2)).groups()
    assert luhn(a) and luhn(b) and a[0] == b[0] == "4" and (a, b) != ("4111 1111 1111 1111", "4845168114407329")
    assert (c, d) == ("4845168114407321", "1234567890123456")
    assert re.fullmatch(r'token = "(?!04dbeb)[0-9a-f]{40}" end (?!04DBEB)[0-9A-F]{40}!!', text(out, 3))
    assert re.fullmatch(r"SSN (?!123)\d{3}-\d{2}-\d{4} \(\d{3}\) \d{3}-\d{4} [A-Z]{2}\d{20}", text(out, 11))
    t = text(out, 12)
    assert len(t) == len(TEXTS[12]) and "me@x.org" not in t
    assert re.fullmatch(r"password: (?!hunter)[a-z]{6}\d[a-z]{6}\d \$1 \\1 \+49 \d\d \d{6}", text(out, 13))


def test_coreference_gender_and_script(out):
    a, b = re.search(r"Write to (\S+),.* from (\S+) now", text(out, 1)).groups()
    assert text(out, 5) == f"{a} and {b} again; 300.1.1.1 is no address, v1.2.3 neither"
    assert {r.text for r in out if r.doc_id == 1 or (r.doc_id is None and r.text.startswith("Write"))} == {text(out, 1)}
    m = re.fullmatch(r"Mrs\. (\w+a) (\w+) met Mr\. (\w+n) (\w+)\. Mrs\. (\w+) left; Herr (\w+) stayed\. Dr\. (\w+) (\w+)", text(out, 4)).groups()
    assert m[1] == m[3] == m[4] and len({m[0], m[1], m[2], m[5], m[7]}) == 5
    m = re.fullmatch(r"Госпожа ([А-я]+а) ([А-я]+) и Г-н ([А-я]+н) ([А-я]+); Κυρία ([Α-Ωα-ω]+)", text(out, 9))
    assert m and "Анна" not in m[0]


def test_collisions_are_drawn_again(spark):
    rows = [("ssn", f"{i:02d}") for i in range(40)] + [("secret", f"{i}") for i in range(9)]  # 9 of 16 values are originals
    drawn = draw(spark.createDataFrame(rows, "kind string, value string").coalesce(1), KEY).collect()
    assert len(drawn) == 49 == len({(r.kind, r.surrogate) for r in drawn})
    assert not {(r.kind, r.surrogate) for r in drawn} & set(rows)


def test_empty_table_and_plan(spark):
    df = replace_entities(spark.createDataFrame([], "doc_id long, text string"), KEY)
    assert df.count() == 0
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_each_kind_right_behind_a_letter_of_text_without_blanks(spark):
    mentions = ["me@x.org", "04dbebab91ab85687d33eeaaf9ac699e1188f962", "DE89370400440532013000", "+49 30 901820", "(212) 555-0100",
                "212-555-0100", "4111111111111111", "123-45-6789", "43.21.141.162", "Mrs. Anna Smith", "Госпожа Петрова"]
    texts = []
    for side in ("联系", "電話は", "โทรที่", "전화"):
        texts += [(side, f"{side}{m}。{side}") for m in (*mentions, "password=correct-horse-battery")]
        texts += [(side, f"{side}{m}{side}") for m in mentions[1:]]
    out = replace_entities(spark.createDataFrame([(i, t) for i, (_, t) in enumerate(texts)], "doc_id long, text string"), KEY).collect()
    for r in out:
        side, was = texts[r.doc_id]
        assert (r.n_entities, r.text != was, r.text.endswith(side)) == (1, True, True), was
        assert not any(m in r.text for m in (*mentions, "correct-horse")), was
        assert "@" in was or r.text.startswith(side), was  # letters of any script belong to a mail address


def test_prefilter_holds_every_text_with_a_mention(spark):
    words = [w for x in ("token", "secret", "password", "passwd", "api_key", "api-key", "apikey", "access_key", "accesskey")
             for w in (x, x.upper(), x.title(), x.swapcase())]
    texts = [f"my {w}{sep}correct-horse-battery" for w in words for sep in (": ", "=", '" = "')]
    texts += [f"{a}{dot} Anna" for a in ("Anna", *FEMALE, *MALE, *EITHER) for dot in ("", ".")]
    texts += ["deadbeef" * 4, "DEADBEEF" * 4, "deadbeef" * 3, "no mention", "API and access token", ""]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    judged = df.select("text", may_mention(F.col("text")).alias("may"), F.regexp_count("text", F.lit(MENTION)).alias("n")).collect()
    assert sum(r.n for r in judged) == len(texts) - 2 - 4
    assert not [r.text for r in judged if r.n and not r.may]
    assert not {r.doc_id for r in replace_entities(df, KEY).collect() if r.n_entities == 0} ^ {
        i for i, r in enumerate(judged) if r.n == 0}


def test_secret_behind_its_word_is_one_whatever_its_shape(spark):
    shapes = ["1234567890123456", "4845168114407321", "4111111111111111", "123-45-6789-0", "12345678901234", "DE89370400440532013000",
              "192.168.100.200", "AB12" + "C3D4" * 7]
    texts = [f"access_key={v} order {v} password: {v}" for v in shapes]
    out = replace_entities(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), KEY).collect()
    for r in out:
        v = shapes[r.doc_id]
        a, order, b = re.fullmatch(r"access_key=(\S+) order (\S+) password: (\S+)", r.text).groups()
        assert a == b != v and len(a) == len(v)
        plain = v in ("1234567890123456", "4845168114407321", "123-45-6789-0", "12345678901234")
        assert (order == v) == plain and r.n_entities == (2 if plain else 3)


def test_bare_names_and_gender_of_either_forms(spark):
    texts = ["Mrs. Anna Smith spoke. Smith said so, Anna left; Smith's car, non-Smith, Smith-Jones, Smithson, Hannah, anna.",
             "Dr. Anna Smith and Prof. Maria Jones; Dr. Robin Poe, Dr. Kim Ray.", "Mrs. Maria Stone", "Smith and Anna are no persons here.",
             "Mr. Kim Ray, Mr. Robin Fox, Mrs. Robin Fay", "Mrs. Ann-Marie Roe: Ann-Marie, Ann and Roe-Lee", "Mr. Paul Ford met Mrs. Ford Paul. Ford!",
             "Mrs. Anna Smith会见Smith先生。Herr Müller, Müller 4111111111111111 Müller"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    out = {r.doc_id: r for r in replace_entities(df, KEY).collect()}
    anna, smith = re.match(r"Mrs\. (\w+a) (\w+) ", out[0].text).groups()
    assert out[0].text == texts[0].replace("Hannah", "H_").replace("Smithson", "S_").replace("Smith", smith).replace("Anna", anna).replace(
        "S_", "Smithson").replace("H_", "Hannah")
    assert out[0].n_entities == 6
    maria, jones, robin, poe, kim, ray = re.fullmatch(
        rf"Dr\. {anna} {smith} and Prof\. (\w+a) (\w+); Dr\. (\w+) (\w+), Dr\. (\w+n) (\w+)\.", out[1].text).groups()
    assert out[2].text.startswith(f"Mrs. {maria} ") and out[4].text.startswith(f"Mr. {kim} {ray}, ")
    assert robin[-1] not in "aeiou" and robin not in out[4].text
    assert out[3].text == texts[3] and out[3].n_entities == 0
    given, roe = re.match(r"Mrs\. (\w+) (\w+):", out[5].text).groups()
    assert out[5].text == f"Mrs. {given} {roe}: {given}, Ann and {roe}-Lee" and out[5].n_entities == 3
    assert re.fullmatch(r"Mr\. \w+n (\w+) met Mrs\. \w+a \w+\. \1!", out[6].text)
    assert re.fullmatch(rf"Mrs\. {anna} {smith}会见{smith}先生。Herr (\w+), \1 \d{{16}} \1", out[7].text) and out[7].n_entities == 6


def test_account_numbers_keep_country_and_check_digits_and_addresses_their_class(spark):
    rows = [(1, "DE89370400440532013000 and GB82 WEST 1234 5698 7654 32"), (2, "10.0.0.1 192.168.1.1 127.0.0.1 172.20.3.4 169.254.7.7 8.8.4.4"),
            (3, "version 1.2.3.4 stays, at 1.2.3.4 not"), (4, "дом@почта.рф 山田@例え.jp")]
    got = {r.doc_id: r.text for r in replace_entities(spark.createDataFrame(rows, "doc_id long, text string"), KEY).collect()}

    def valid(iban):
        s = iban.replace(" ", "")
        return int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1

    a, b = got[1].split(" and ")
    assert re.fullmatch(r"DE\d{20}", a) and re.fullmatch(r"GB\d\d [A-Z]{4} \d{4} \d{4} \d{4} \d\d", b) and valid(a) and valid(b)
    assert a != rows[0][1][:22] and b != rows[0][1][27:]
    new = got[2].split(" ")
    for old, x, pattern in zip(rows[1][1].split(" "), new, (r"10\.", r"192\.168\.", r"127\.", r"172\.(1[6-9]|2\d|3[01])\.", r"169\.254\.", r"(1[1-9]|[2-9]\d)\."), strict=True):
        assert re.match(pattern, x) and x != old and all(0 <= int(n) < 256 for n in x.split("."))
    assert got[3].startswith("version 1.2.3.4 stays, at ") and not got[3].endswith("1.2.3.4 not")
    assert re.fullmatch(r"[а-я]{3}@[а-я]{5}\.рф [一-龥]{2}@[一-龥ぁ-ん]{2}\.jp", got[4]) and "山田" not in got[4]


def test_clashing_columns_pass_through(spark):
    names = ["doc_id", "text", "of", "hash", "known", "names", "found", "gaps", "of_id", "of_text", "__hash", "__found", "__gaps"]
    rows = [(i, t, *[f"{i}{n}" for n in names[2:]]) for i, t in enumerate(["me@x.org", "none", None])]
    out = replace_entities(spark.createDataFrame(rows, names), KEY).collect()
    assert sorted((r.doc_id, *[r[n] for n in names[2:]], r.n_entities) for r in out) == sorted((r[0], *r[2:], int(r[1] == "me@x.org")) for r in rows)


def test_equals_plain_replacement(spark, frame):
    """Every mention is replaced by the surrogate that its entities got, found once more by a plain pattern over the original."""
    simple = re.compile(r"[a-z]+\d*@[a-z]+\.org|\d{3}-\d{2}-\d{4}|\(\d{3}\) \d{3}-\d{4}")
    texts = [f"write ann{i % 7}@site.org or 1{i % 5}3-45-67{i % 9}9, (21{i % 4}) 555-01{i % 10}0; ann{i % 3}@site.org" for i in range(60)]
    out = {r.doc_id: r for r in replace_entities(frame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string"), KEY).collect()}
    known = {}
    for i, t in enumerate(texts):
        parts, new = simple.split(t), out[i].text
        place = 0
        for k, m in enumerate(simple.findall(t)):
            place += len(parts[k])
            assert new[:place].endswith(parts[k])
            surrogate = new[place:place + len(m)]
            assert known.setdefault(m, surrogate) == surrogate and surrogate != m
            place += len(m)
        assert new[place:] == parts[-1] and out[i].n_entities == 4
    assert len(set(known.values())) == len(known) and not set(known) & set(known.values())
