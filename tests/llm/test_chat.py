from collections import defaultdict

import brute
from hypothesis import given, settings
from hypothesis import strategies as st
from landsurvey.llm import chat, queries


def want(rows):
    convs = defaultdict(list)
    for c, n, role, text in rows:
        convs[c].append(((n is not None, n or 0), role or "", text or ""))
    out = {}
    for c, turns in convs.items():
        turns = sorted(turns)
        loss = "".join(t for _, r, t in turns if r == "assistant")
        out[c] = (len(turns), brute.sha("".join(f"{r}\n{t}\n" for _, r, t in turns)), len(loss), brute.sha(loss))
    return out


def got(df):
    return {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in df.collect()}


def test_whole_table(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").collect()]
    text = "</s>[INST] ok [/INST]"
    rows += [(-1, 0, "user", text), (-1, 1, "assistant", text)]
    assert got(queries.op9_chat(spark, sf_dir)) == want(rows)


def test_odd_rows(spark):
    rows = [
        (None, 0, "user", "x"), (1, None, None, None), (1, None, None, None), (2, 5, "assistant", "\\"), (2, 1, "us\ner", "<s>\\n</s>"),
        (3, 0, "assistant", ""), (4, 0, "[INST]", "é" * 50_000), (5, 0, "assistant", "[INST] a [/INST]"), (5, 0, "assistant", "b"),
    ]
    df = spark.createDataFrame([(*r, 1, "k") for r in rows], "conv_id bigint, turn bigint, role string, text string, pack int, segments string")
    assert got(chat.report(spark, df)) == want(rows)
    assert chat.report(spark, df.limit(0)).count() == 0


def test_hot_prefix_fills_bounded_packs(spark):
    rows = [(c, t, "user" if t % 2 == 0 else "assistant", "shared" if t < 2 else f"{c % 50}-{t}") for c in range(300) for t in range(4)]
    rows += [(c, 0, "user", "alone") for c in range(1000, 1100)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    packs = chat.pack_conversations(spark, df, pack=20).collect()
    assert max(len(p.conversations) for p in packs) < 80
    assert got(chat.read_back(spark, spark.createDataFrame(packs, chat.PACK_SCHEMA))) == want(rows)
    for p in packs:
        texts = [p.text[s.start : s.end] for s in p.segments]
        assert sum("shared" in t for t in texts) <= 2  # each shared turn once
        assert p.segments[-1].end == len(p.text)
        for s in p.segments:
            assert s.position == sum(a.end - a.start for a in s.ancestors)
            assert all(a.end <= s.start for a in s.ancestors)


def test_long_conversations_have_few_intervals():
    turns = [("user" if i % 2 == 0 else "assistant", f"turn {i}") for i in range(3000)]
    text, segments, owners = chat.layout([(1, turns), (2, turns[:2000] + [("user", "another way")]), (3, turns[:10])])
    assert max(len(s[3]) for s in segments) <= 2
    assert sorted(c for c, _ in owners) == [1, 2, 3]
    for c, k in owners:
        start, end, position, above, *_ = segments[k]
        path = "".join(text[a:b] for a, b in [*above, (start, end)])
        assert position == sum(b - a for a, b in above)
        assert chat.parse(path) == {1: turns, 2: turns[:2000] + [("user", "another way")], 3: turns[:10]}[c]


@given(st.lists(st.tuples(st.text("<s>/[INT] \\\nab", max_size=12), st.text("<s>/[INST] \\\nab", max_size=20)), max_size=4))
@settings(max_examples=300, deadline=None)
def test_template_round_trip(turns):
    assert chat.parse("".join(chat.format_turn(r, t)[0] for r, t in turns)) == turns
