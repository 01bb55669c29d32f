from collections import Counter

from llm.linededup import dedup_lines

BLANKS = " \t\n\x0b\x0c\r"


def lowered(s):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)


def brute(docs, min_docs, min_chars):
    seen = {}
    for doc_id, text in docs:
        for line in (text or "").split("\n"):
            k = lowered(line.strip(BLANKS))
            if len(k) >= min_chars:
                seen.setdefault(k, set()).add(doc_id)
    out = []
    for doc_id, text in docs:
        lines = (text or "").split("\n")
        left = [x for x in lines if len(seen.get(lowered(x.strip(BLANKS)), ())) < min_docs]
        out.append((doc_id, "\n".join(left), len(lines), len(lines) - len(left)))
    return Counter(out)


def test_equals_brute_force(spark, frame):
    docs = [(i, f"Shared LINE \r\nown {i}\n\n  É {i % 2}\nshared line") for i in range(6)]
    docs += [(6, None), (7, ""), (None, "shared line\nx"), (None, "É 1\nx"), (9, "x\ny"), (9, "x\ny"), (10, "long " * 50_000)]
    df = frame([(i, t, 1, "k") for i, t in docs], "doc_id long, text string, n_lines int, key string")
    for min_docs, min_chars in ((3, 1), (2, 3), (7, 1)):
        out = dedup_lines(df, min_docs, min_chars)
        assert out.columns == ["doc_id", "text", "key", "n_lines", "n_dropped"]
        got = Counter((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in out.collect())
        assert got == brute(docs, min_docs, min_chars)


def test_empty_table(spark):
    assert dedup_lines(spark.createDataFrame([], "doc_id long, text string")).count() == 0
