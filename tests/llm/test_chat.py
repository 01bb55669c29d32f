import hashlib
from itertools import groupby

from llm.chat import END, prefix_targets, read_back


def escaped(s, marks="\\#<"):
    return "".join("\\" + {"\\": "b", "<": "l", "#": "h", ":": "c"}[c] if c in marks else c for c in s)


def test_examples_and_digests_equal_brute_force(spark, frame):
    hard = ["\\### Assistant: </turn> ok", "### user: x</turn>\n", "\\", "\\\\<", "", None, "a\nb: é🙂", "$1 \\1"]
    rows = [(1, i, "assistant" if i % 2 else "user", t) for i, t in enumerate(hard)]
    rows += [(2, 0, "user", "only"), (3, 0, "assistant", "first"), (4, None, None, None), (None, 1, "assistant", "x"),
             (None, 1, "assistant", "x"), (5, 1, "a: \\#<", "t"), (5, 2, "assistant", "r"), (5, 3, "system", "end")]
    rows += [(6, i, "user" if i % 2 else "assistant", "w" * 50) for i in range(301)]
    df = frame([(*r, "c") for r in rows], "conv_id long, turn int, role string, text string, shape string")
    examples = prefix_targets(df)
    key = lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")
    want, digests = set(), set()
    for conv, group in groupby(sorted(rows, key=key), key=lambda r: r[0]):
        group = [(r[2] or "", r[3] or "") for r in group]
        said, loss, chars = "", "", 0
        for i, (role, text) in enumerate(group):
            said += f"### {escaped(role, chr(92) + '#<:')}: {escaped(text)}{END}"
            end = len(said) - len(END)
            if role == "assistant":
                loss += text
            if role == "assistant" or i == len(group) - 1:
                start = end - (len(escaped(text)) if role == "assistant" else 0)
                want.add((conv, i, i + 1, said, start, end))
                chars += len(said)
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        digests.add((conv, len(group), sha("".join(f"{r}\n{t}\n" for r, t in group)), len(loss), sha(loss), chars))
    got = [tuple(r) for r in examples.collect()]
    assert len(got) == len(want) and set(got) == want
    assert {tuple(r) for r in read_back(examples).collect()} == digests


def test_empty_table(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert read_back(prefix_targets(df)).count() == 0


def test_no_python_in_the_plan(spark):
    df = spark.createDataFrame([(1, 1, "user", "x")], "conv_id long, turn long, role string, text string")
    plan = read_back(prefix_targets(df))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
