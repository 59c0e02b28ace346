import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfmark.llm import chat
from tests.llm.odd import sentence

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def talks(rng, n):
    rows = []
    for conv in range(n):
        roles = ["system"] * (rng.random() < 0.3) + ["user", "assistant"] * rng.randrange(1, 5)
        for turn, role in enumerate(roles):
            size = {"system": 6, "user": 12, "assistant": 60}[role]
            rows.append((conv, turn, role, sentence(rng, rng.randrange(size // 2, size + 2)) + ("?" if role == "user" else ".")))
    return rows


def model(seed):
    rng = np.random.default_rng(seed)
    return chat.RoleModel(rng.integers(0, 9, 3), rng.integers(0, 9, (3, 3)), rng.integers(0, 3, (3, chat.SHAPES)))


@pytest.mark.parametrize("seed", range(5))
def test_viterbi_equals_trying_all_paths(seed):
    m, rng = model(seed), np.random.default_rng(seed)
    shapes = rng.integers(0, chat.SHAPES, 6)

    def score(path, before):
        total = m.start[path[0]] if before is None else m.step[before, path[0]]
        return total + sum(m.step[a, b] for a, b in itertools.pairwise(path)) + sum(m.emit[r, s] for r, s in zip(path, shapes, strict=True))

    for before, end in [(None, None), (1, None), (None, 2), (0, 1)]:
        paths = [p for p in itertools.product(range(3), repeat=6) if end is None or p[-1] == end]
        found = m.decode(shapes, before, end)
        assert score(found, before) == pytest.approx(max(score(p, before) for p in paths))
    table = m.table(shapes, False)
    for a, b in itertools.product(range(3), repeat=2):
        assert table[a, b] == pytest.approx(score(m.decode(shapes, a, b), a))


def test_held_out_roles_are_recovered(spark):
    rows = talks(random.Random(1), 300)
    found = chat.op10(spark.createDataFrame(rows, SCHEMA)).collect()
    truth = {(c, t): r for c, t, r, _ in rows}
    assert len(found) == len(rows)
    right = [truth[r.conv_id, r.turn] == r.role for r in found if r.held_out]
    assert sum(right) / len(right) > 0.95


def test_cuts_change_nothing(spark, monkeypatch):
    rng = random.Random(2)
    rows = talks(rng, 40) + [(7_000, n, rng.choice([None, "user", "assistant"]), sentence(rng, rng.randrange(1, 60))) for n in range(150)]
    lines = spark.createDataFrame(rows, SCHEMA)
    known = F.when(~chat.held_out(F.col("conv_id")), chat.canonical_role(F.col("role"))).alias("known")
    ordered = chat._lines(lines.select("conv_id", "turn", "text", known))
    m, _ = chat.fit(ordered)
    shapes = {(int(r.conv), r.turn): r["shape"] for r in ordered.collect()}

    def likelihood(found):
        total, before = 0.0, {}
        for r in sorted(found):
            role = chat.ROLES.index(r.role)
            total += (m.step[before[r.conv_id], role] if r.conv_id in before else m.start[role]) + m.emit[role, shapes[r.conv_id, r.turn]]
            assert r.starts == (before.get(r.conv_id) != role)
            before[r.conv_id] = role
        return total

    results = []
    for size in (10**6, 9):
        monkeypatch.setattr(chat, "PART_ROWS", size)
        found = chat.op10(lines).collect()
        results.append(likelihood(found))
        texts = {}
        for r in sorted(found):
            texts[r.conv_id] = texts.get(r.conv_id, "") + r.rendered
        assert all(t.count(chat.OPEN) == t.count(chat.CLOSE) and t.endswith(chat.CLOSE) for t in texts.values())
    assert results[0] == pytest.approx(results[1])


def test_markers_decide_where_nothing_is_known(spark):
    rows = [(1, 0, None, "System: be brief"), (1, 1, None, "User: what is it?"), (1, 2, None, "Assistant: a stone <|im_end|>"), (1, 3, None, "**Human:** and this")]
    found = chat.op10(spark.createDataFrame(rows, SCHEMA)).orderBy("turn").collect()
    assert [r.role for r in found] == ["system", "user", "assistant", "user"]
    assert "".join(r.rendered for r in found) == (
        "<|im_start|>system\nbe brief<|im_end|>\n<|im_start|>user\nwhat is it?<|im_end|>\n"
        "<|im_start|>assistant\na stone < |im_end|><|im_end|>\n<|im_start|>user\nand this<|im_end|>\n"
    )


def test_transcripts_within_a_text_are_parsed(spark):
    talk = "User: hi there\nAssistant: hello\n\nhow are you?\n  [Human] bye\n### assistant: so long"
    rows = [(1, 0, None, talk), (2, 0, "user", "one line\nand one without a marker"), (3, 0, None, "User: a\nUser: b"), (1, 0, None, talk)]
    found = chat.op10(spark.createDataFrame(rows[:3], SCHEMA)).orderBy("conv_id", "turn", "piece").collect()
    assert [(r.conv_id, r.role, r.starts) for r in found] == [
        (1, "user", True), (1, "assistant", True), (1, "user", True), (1, "assistant", True), (2, "user", True), (3, "user", True), (3, "user", False),
    ]
    assert "".join(r.rendered for r in found[:4]) == (
        "<|im_start|>user\nhi there<|im_end|>\n<|im_start|>assistant\nhello\n\nhow are you?<|im_end|>\n"
        "<|im_start|>user\nbye<|im_end|>\n<|im_start|>assistant\nso long<|im_end|>\n"
    )
    assert found[4].rendered == "<|im_start|>user\none line\nand one without a marker<|im_end|>\n"
    assert found[5].rendered + found[6].rendered == "<|im_start|>user\na\nb<|im_end|>\n"
    twice = chat.op10(spark.createDataFrame([rows[0], rows[3]], SCHEMA)).collect()
    assert [r.role for r in sorted(twice, key=lambda r: r.piece)] == ["user"] * 2 + ["assistant"] * 2 + ["user"] * 2 + ["assistant"] * 2


@pytest.mark.parametrize("rows_a_part", [10**6, 7])
def test_long_transcripts_keep_their_markers(spark, monkeypatch, rows_a_part):
    """Every line group with a marker of its own gets that role, whatever the cuts, and nothing is lost."""
    monkeypatch.setattr(chat, "PART_ROWS", rows_a_part)
    rng, rows, truth = random.Random(4), [], {}
    for conv in range(12):
        roles = [rng.choice(chat.ROLES) for _ in range(rng.randrange(1, 30))]
        body = [sentence(rng, rng.randrange(1, 9)) + rng.choice(["", "\n" + sentence(rng, 3)]) for _ in roles]
        rows.append((conv, 0, None, "\n".join(f"{rng.choice(chat.ALIASES[r]).title()}: {b}" for r, b in zip(roles, body, strict=True))))
        truth[conv] = (roles, body)
    found = chat.op10(spark.createDataFrame(rows, SCHEMA)).collect()
    for conv, (roles, body) in truth.items():
        own = sorted((r for r in found if r.conv_id == conv), key=lambda r: r.piece)
        assert [r.role for r in own] == roles
        want, before = "", None
        for role, text in zip(roles, body, strict=True):
            want += "\n" if role == before else ("" if before is None else chat.CLOSE) + f"{chat.OPEN}{role}\n"
            want, before = want + text, role
        assert "".join(r.rendered for r in own) == want + chat.CLOSE


def test_odd_rows(spark):
    rows = talks(random.Random(3), 20) + [(None, None, None, None), (None, 1, "x", ""), (5, None, "user", "early"), (5, 0, "user", None), (6, 0, "tool", "y")]
    rows += [(6, 0, "tool", "y")] * 2
    lines = spark.createDataFrame(rows, SCHEMA).withColumn("known", F.lit("clash")).withColumn("part", F.lit(1))
    found = chat.op10(lines).collect()
    assert len(found) == len(rows) and all(r.role in chat.ROLES for r in found)
    assert [r.rendered for r in found if r.conv_id is None][-1].endswith(chat.CLOSE)


def test_empty_table(spark):
    assert chat.op10(spark.createDataFrame([], SCHEMA)).collect() == []
