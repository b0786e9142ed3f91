import re

from drawloom.llm.common import keyed
from drawloom.llm.quality_rules import RULES, Rule, base_counts, judge, order_rules


def plain(t):
    words = re.findall(r"[^\x20\x09-\x0D]+", t or "")
    grams = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    hit = {i + k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(5)}
    lines = [x for x in (t or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return [len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), len(hit)]


TEXTS = ["", None, "one", "a b c d e " * 3, "héé x ü\x0by\x1fz\n\n \nhéé", "x " * 30, "a b c d e f g h i j k " + "l\nl\nl\n", "### *** " * 9, "q w e r t y u i o p a s " + "q w e r t", "日本 " * 4 + "\r\n"]


def test_counts_equal_plain(spark):
    assert [list(s.values()) for s in base_counts([(t or "").encode() for t in TEXTS])] == [plain(t) for t in TEXTS]
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").selectExpr("*", "1 as id", "true as kept")
    got = {r["doc_id"]: list(r)[1:6] for r in judge(df).collect()}
    assert got == {i: plain(t) for i, t in enumerate(TEXTS)}
    assert judge(df.limit(0)).count() == 0


def test_order_by_rejections_per_second(spark):
    slow = Rule("slow", lambda t, s: sum(range(20_000)) > 0 and t.startswith(b"7"))
    never = Rule("never", lambda t, s: False)
    quick = Rule("quick", lambda t, s: t.startswith(b"7"))
    df = spark.range(200).selectExpr("concat(id % 10, ' b c d e f g h i j k l') as text")
    assert [r.name for r in order_rules(keyed(df.selectExpr("1 as doc_id", "text"), "doc_id", "text"), [slow, never, quick])][0] == "quick"
    verdicts = [{i: r["kept"] for i, r in enumerate(judge(df.selectExpr("1 as doc_id", "text"), rules).orderBy("word_chars", "kept").collect())} for rules in ([slow, quick, never, *RULES], [*RULES, never, quick, slow])]
    assert verdicts[0] == verdicts[1]


def test_long_and_repeated_rows(spark):
    long = " ".join("".join(chr(97 + int(c)) for c in str(i)) for i in range(300_000))
    df = spark.createDataFrame([(1, long), (1, long), (2, long + " ### " * 100_000), (3, "a b " * 7)], "doc_id long, text string")
    got = sorted((r["doc_id"], r["n_words"], r["kept"]) for r in judge(df).collect())
    assert got == [(1, 300_000, True), (1, 300_000, True), (2, 400_000, False), (3, 14, False)]
