import hashlib
import itertools
import random
from collections import defaultdict

from addrlink.llm import chat as c

SCHEMA = "conv_id long, turn long, role string, text string, example int, whole string, turns string, loss string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "w", "t", "l") for r in rows], SCHEMA)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute(rows):
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        convs[conv].append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for conv, turns in convs.items():
        turns.sort()
        loss = "".join(t for *_, r, t in turns if r == "assistant")
        out[conv] = (len(turns), sha("".join(f"{r}\n{t}\n" for *_, r, t in turns)), len(loss), sha(loss))
    return out


def got(df):
    return {r[0]: tuple(r)[1:5] for r in c.read_back(c.examples(df)).select(
        "conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256").collect()}


def test_examples_of_a_conversation(spark):
    rows = [(1, 2, "assistant", "B"), (1, 0, "system", "S"), (1, 1, "user", "A"), (1, 3, "user", "C"),
            (1, 4, "assistant", "D"), (1, 5, "user", "E")]
    out = sorted(c.examples(frame(spark, rows)).collect())
    first = "### system: S</turn>\n### user: A</turn>\n### assistant: B</turn>\n"
    second = first + "### user: C</turn>\n### assistant: D</turn>\n"
    assert [r["text"] for r in out] == [first, second, second + "### user: E</turn>\n"]
    assert [(r["n_turns"], r["complete"]) for r in out] == [(3, False), (5, False), (6, True)]
    assert [r["text"][r["loss_start"]:r["loss_end"]] if r["loss_start"] is not None else None for r in out] == ["B", "D", None]


PARTS = ["### ", "## # ", "#", "##\\# ", "</turn>", "<\\/turn>", "<", "/turn>", "\\", "\\\\", "\n", ": ", "### assistant: ",
         "é𝒳", "́", "$1", " ", "\\c", "\\h", "</turn>\n### user: x"]


def test_everything_reads_back(spark):
    rng = random.Random(4)
    texts = ["".join(rng.choices(PARTS, k=rng.randint(0, 9))) for _ in range(1500)] + ["".join(p) for p in itertools.product(PARTS[:12], repeat=2)]
    roles = ["user", "assistant", "system", "a: b", "\\c", "</turn>\n### ", "\\\\:", "", None, "tool:<#>"]
    rows = [(i // 9, i % 9, rng.choice(roles), t) for i, t in enumerate(texts)]
    assert got(frame(spark, rows)) == brute(rows)
    df = frame(spark, [(i, 0, r, t) for i, (r, t) in enumerate(itertools.product(roles[:3], texts[:200]))])
    pieces = [r["text"] for r in c.examples(df).collect()]
    assert all(p.count(c.END) == 1 and p.count(c.START) == 1 for p in pieces)  # no text holds a control string


def test_escapes_are_reversible(spark):
    texts = ["".join(p) for n in range(5) for p in itertools.product(["##", "# ", "\\", "<", "/turn>"], repeat=n)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = df.select("t", c.escape(df.t).alias("e"), c.unescape(c.escape(df.t)).alias("u")).collect()
    assert all(r["u"] == r["t"] and "### " not in r["e"] and c.END not in r["e"] for r in rows)
    assert len({r["e"] for r in rows}) == len(set(texts))


def test_odd_rows(spark):
    long = "word </turn> " * 100_000
    rows = [(1, None, None, None), (1, 0, "assistant", None), (1, 0, "assistant", ""), (None, 1, "user", "a"),
            (None, 2, "assistant", "b"), (2, 0, "assistant", long), (2, 1, "user", long), (3, 0, "user", "no reply"),
            (4, 1, "assistant", "x"), (4, 1, "assistant", "x"), (4, 1, "assistant", "w"), (5, 7, "assistant", "only")]
    assert got(frame(spark, rows)) == brute(rows)
    assert c.examples(frame(spark, [])).collect() == [] and got(frame(spark, [])) == {}


def test_many_turns_of_one_conversation(spark):
    rows = [(1, t, "assistant" if t % 2 else "user", f"text {t} " * 20) for t in range(600)]
    assert got(frame(spark, rows)) == brute(rows)
    sizes = c.examples(frame(spark, rows)).selectExpr("count(*)", "max(length(text))").first()
    assert sizes[0] == 300


def test_native_and_one_shuffle(spark):
    plan = c.read_back(c.examples(frame(spark, [(1, 0, "user", "a")])))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "Cartesian", "NestedLoop"))
    assert plan.count("Exchange") == 1
