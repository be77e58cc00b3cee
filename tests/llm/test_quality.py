import random
import re

from tableworks.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    text = text or ""
    words = WORD.findall(text)
    windows = {}
    for i in range(len(words) - 4):
        windows.setdefault(tuple(words[i : i + 5]), []).append(i)
    covered = {p for at in windows.values() if len(at) > 1 for i in at for p in range(i, i + 5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    base = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), base)


def texts():
    r = random.Random(4)
    words = ["the", "of", "a", "é", "x|y", "w#", "\U0001f600z", "..."]
    out = ["", None, " ", "\n\n", "one", "a b c d e", "a b c d e a b c d e", "a a a a a a a", "x " * 3000, "l\nl\nl\n\n l", "\x1fA\x0bB"]
    for n in (3, 12, 40, 200):
        out += ["".join(r.choice(words) + r.choice([" ", "\n", "  ", "\t"]) for _ in range(n)) for _ in range(20)]
    phrase = " ".join(r.choices(words, k=9))
    out += [f"{phrase} q {phrase} z {' '.join(map(str, range(100)))}"]
    return out


def test_counts_are_those_of_a_plain_loop(spark):
    rows = list(enumerate(texts())) + [(0, ""), (None, "x y")]
    df = spark.createDataFrame([(k, t, "w", 0) for k, t in rows], "doc_id long, text string, words string, n_words int")
    got = quality.judge(df)
    assert set(df.columns) < set(got.columns)
    cols = ["doc_id"] + [f"q_{c}" for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")]
    assert sorted(map(str, (tuple(r) for r in got.select(*cols).collect()))) == sorted(str((k, *plain(t))) for k, t in rows)


def test_rules(spark):
    prose = "the cat of the house was in a garden and it had " + " ".join(f"w{chr(97 + i % 26)}{i}x" for i in range(60))
    cases = {
        1: (prose, []), 2: (prose.replace(" ", "### "), ["symbols_per_word", "stop_word_share"]),
        3: (prose.upper().replace(" ", "!! "), ["shouts_per_word", "stop_word_share"]),
        4: ("\n".join(["same line here"] + [f"line {chr(97 + i)} of the text" for i in range(8)] + ["same line here"] * 6), ["dup_line_share"]),
        5: ("\n".join(f"- point {chr(97 + i)} of the list" for i in range(12)), ["bullet_line_share"]),
        6: ("\n".join(f"point {chr(97 + i)} of the list..." for i in range(12)), ["ellipsis_line_share"]),
        7: (" ".join(f"{'long' * 6}{i}" for i in range(20)), ["mean_word_chars"]),
        8: ("nine words are too few for this rule so", []),
    }
    df = spark.createDataFrame([(k, t) for k, (t, _) in cases.items()], "doc_id long, text string")
    got = {r.doc_id: r for r in quality.judge(df).collect()}
    for k, (_, failed) in cases.items():
        assert got[k].q_failed == failed, k
        assert got[k].q_kept == (not failed and not got[k].q_base_failed)
    assert got[1].q_kept and got[8].q_base_failed
    one = [quality.Rule("symbols_per_word", high=9.0)]
    assert {r.doc_id: r.q_kept for r in quality.judge(df, rules=one).collect()}[2]


def test_one_projection(spark):
    plan = quality.judge(spark.range(1).selectExpr("id doc_id", "'x' text"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_empty(spark):
    assert quality.judge(spark.createDataFrame([], "doc_id long, text string")).collect() == []
