"""JSON judged as text, against a reader of JSON."""

import json
import random
import time

from pyspark.sql import functions as F

from casetrail.functions.json_text import is_json, on_one_line
from casetrail.operators import delivery

TOKENS = ['{', '}', '[', ']', ':', ',', '"a"', '"b\\n\\u00e9"', '1', '-0.5e+3', 'true', 'null', 'NaN', '-Infinity', ' ', '"s', '01', '-',
          '1.', '\\', '"\\x"', '\t', '\x01', 'é', '"é{}[]"', 'false', '"\\""', '.5', '1e5', '+1', '-NaN', '""', '\n', '"\n"', '\x02', '\x03']


def value(rng, depth=0):
    kind = rng.random()
    if depth > 4 or kind < 0.4:
        return rng.choice(['"a"', '1', '-0.5e+3', 'true', 'null', 'NaN', '"é{}[],:"', '"\\\\"', '""'])
    if kind < 0.7:
        return "[" + " ,".join(value(rng, depth + 1) for _ in range(rng.randrange(4))) + "]"
    return "{ " + ",".join(f'"k{rng.randrange(3)}" : ' + value(rng, depth + 1) for _ in range(rng.randrange(4))) + "}"


def readable(text):
    try:
        json.loads(text)
    except ValueError:
        return False
    return True


def judged(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    return [r["ok"] for r in df.orderBy("i").select(is_json(F.col("t")).alias("ok")).collect()]


def test_random_texts(spark):
    rng = random.Random(4)
    texts = []
    for _ in range(2_000):
        text = value(rng)
        at = rng.randrange(len(text) + 1)
        texts += [text, text[:at] + rng.choice(TOKENS) + text[at + rng.randrange(3):]]
        texts.append("".join(rng.choice(TOKENS) for _ in range(rng.randrange(9))))
    wanted = [readable(t) for t in texts]
    assert judged(spark, texts) == wanted and 2_000 < sum(wanted) < 4_000


def test_long_deep_and_missing(spark):
    deep = "[" * 1_100 + '{"a":' * 1_100 + "1" + "}" * 1_100 + "]" * 1_100
    long = '{"id":' + "9" * 1_100 + ',"f":-' + "1" * 400 + "." + "0" * 400 + "e-" + "7" * 40 + "}"
    escapes = '"' + '\\"' * 50_000 + '"'
    mixed = '[{"b":' * 70 + "[]" + "}]" * 70
    assert judged(spark, [mixed, mixed[:-2] + "]}"]) == [True, False]
    assert judged(spark, ["[" * n + "]" * m for n in (63, 64, 65, 129) for m in (n - 1, n)]) == [False, True] * 4
    assert judged(spark, ['{"a":' * n + "1" + "}" * m for n in (63, 64, 65, 129) for m in (n - 1, n)]) == [False, True] * 4
    assert judged(spark, [deep, deep[:-1], "[" + deep + ",]", long, long.replace(":9", ":09"), escapes, escapes[:-1], None]) == [
        True, False, False, True, False, True, False, False]


def test_runs_of_brackets_are_taken_off_whole(spark):
    """Runs of several depths side by side, runs that open or close more than the other, and runs inside runs."""
    run = lambda n, inside: "[" * n + inside + "]" * n
    keyed = lambda n, inside: '{"a":' * n + inside + "}" * n
    good = [
        "[" + ",".join(run(n, "1") for n in (70, 64, 63, 300, 1)) + "]", run(90, keyed(200, run(65, "{}"))), keyed(70, run(70, keyed(70, "[]"))),
        "[" + run(100, "1") + "," + keyed(100, run(80, "null")) + "]", run(100, "1," + run(100, "2")),
    ]
    bad = [good[0] + "]", "[" + good[1], good[2][:-1], good[3].replace("null", "nul"), "[" * 200 + "1" + "]" * 100 + "}" * 100, run(100, "1,")]
    assert judged(spark, good + bad) == [True] * len(good) + [False] * len(bad)


def test_deep_texts_take_few_passes(spark):
    """Deep texts of 1,100 brackets may cost a few times what flat ones of that length do, not a pass for each bracket."""
    texts = spark.range(0, 4_000, 1, 4)
    deep = F.concat(F.repeat(F.lit("["), 1_100), F.col("id").cast("string"), F.repeat(F.lit("]"), 1_100))
    flat = F.concat(F.lit("["), F.repeat(F.lit("1,"), 1_100), F.col("id").cast("string"), F.lit("]"))

    def seconds(text):
        rows = texts.select(text.alias("t"))
        rows.filter(is_json(F.col("t"))).count()
        began = time.perf_counter()
        assert rows.filter(is_json(F.col("t"))).count() == 4_000
        return time.perf_counter() - began

    assert min(seconds(deep) for _ in range(2)) < 8 * min(seconds(flat) for _ in range(2))


def test_a_large_line_is_sent(spark):
    """A heavy permit; the size has no bound of its own."""
    item = '{"event":{"code":"A\\"B","n":[1,2,3]},"d":"2020-01-01"},'
    line = F.concat(F.lit('{"record_id":"x","on_hold_event_set":['), F.repeat(F.lit(item), 20_000), F.lit("1]}"))
    lines = spark.range(1).select(line.alias("value"))
    assert delivery.sendable_lines(lines).count() == 1
    assert delivery.sendable_lines(lines.select(F.concat("value", F.lit("]")).alias("value"))).count() == 0


def test_record_stands_in_the_bucket_as_it_was_sent(spark):
    texts = ['{"record_id": 123456789012345678901234567890123456789012345, "a":1, "a":NaN}', "[1.50, -0]", "{broken", None, '{"a":\n1}']
    bucket = spark.createDataFrame([(i, "r", 400, "e", t) for i, t in enumerate(texts)], "line_no int, record_id string, status_code int, error string, record string")
    got = [r["value"] for r in delivery.error_lines(bucket).collect()]
    head = '{{"line_no":{},"record_id":"r","status_code":400,"error":"e","record":{}}}'
    assert got == [head.format(i, t) for i, t in enumerate([texts[0], texts[1], "null", "null", '{"a": 1}'])]
    assert spark.range(1).select(on_one_line(F.lit("[1,\r\n2]")).alias("t")).first()["t"] == "[1, 2]"
