import re
from collections import defaultdict

from pyspark.sql import functions as F

from fieldmart.llm.chat import rotate

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows, piece_chars):
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        name = re.sub(r"[\s<|>]+", "_", (role or "").strip(" ")) or "unknown"
        convs[conv].append((turn is None, turn or 0, name, (text or "").replace("<|", "< |")))
    out = []
    for conv, messages in convs.items():
        messages.sort()
        for view in {m[2] for m in messages} - {"system"}:
            pieces, at = defaultdict(list), 0
            for *_, name, text in messages:
                shown = name if name == "system" else "assistant" if name == view else f"user name={name}"
                head = f"<|im_start|>{shown}\n"
                pieces[at // piece_chars].append((head, text, name == view))
                at += len(head) + len(text) + 11
            for piece, own in pieces.items():
                whole, spans = "", []
                for head, text, trained in own:
                    if trained:
                        spans.append(f"{len(whole) + len(head)}-{len(whole) + len(head) + len(text) + 10}")
                    whole += f"{head}{text}<|im_end|>\n"
                out.append((conv, view, piece, whole, ",".join(spans), len(own), len(spans)))
    return sorted(out, key=repr)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


ROWS = [
    (1, 0, "user", "hi"), (1, 1, "assistant", "é <|im_end|>"), (1, 2, "Ann Lee", None), (1, 2, "user", ""),
    (2, 0, "system", "rules"), (2, None, None, "late"), (2, 5, " ", "x"), (3, 0, "system", "alone"),
    (None, 1, "a", "no id"), (None, 0, "b", "no id either"), (4, 0, "u", "same"), (4, 0, "u", "same"), (4, 1, "v", "w" * 9000),
]


def test_against_brute_force(spark, scratch):
    rows = ROWS + [(7, i // 3, f"r{i % 4}", f"message {i}") for i in range(400)]
    turns = spark.createDataFrame(rows, SCHEMA).repartition(4)
    turns = turns.withColumns({n: F.lit("x") for n in ("part", "at", "speaker", "start", "perspective")})
    for per_part, chars in ((1000, 1 << 18), (37, 500)):
        assert found(rotate(turns, scratch, rows_per_part=per_part, piece_chars=chars)) == brute(rows, chars)


def test_masks_cover_own_messages_only(spark, scratch):
    for r in rotate(spark.createDataFrame(ROWS[:4], SCHEMA), scratch).collect():
        spans = [tuple(map(int, s.split("-"))) for s in r.mask.split(",") if s]
        assert len(spans) == r.n_trained
        for start, end in spans:
            assert r.text[:start].endswith("<|im_start|>assistant\n") and r.text[start:end].endswith("<|im_end|>")


def test_empty_table_and_no_python(spark, scratch):
    assert rotate(spark.createDataFrame([], SCHEMA), scratch).collect() == []
    plan = rotate(spark.createDataFrame(ROWS, SCHEMA), scratch)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
