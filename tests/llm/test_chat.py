"""Layouts, template and exact round trips."""

import hashlib
import json

from hypothesis import given
from hypothesis import strategies as st

from shelfmark.llm import chat

BITS = st.sampled_from(["<", "<<", "s>", "/s>", "[", "INST]", "/INST]", "OUT]", "SYS>>", "\\", "</s>", "<\\/s>", "a", "\n", "é", "<<ROLE>>", "]"])
TEXT = st.lists(BITS, max_size=12).map("".join)
ROLE = st.sampled_from(["user", "assistant", "system", "tool", "", "</s>"])


@given(st.lists(st.tuples(ROLE, TEXT), max_size=6))
def test_round_trip(turns):
    formatted, mask = chat.render(turns)
    assert chat.parse(formatted) == turns
    assert [chat.unescape(formatted[a:b]) for a, b in mask] == [t for r, t in turns if r == "assistant"]


def test_layouts(spark):
    u, a, s = "question", "answer", "be kind"
    rows = [
        {"messages": [{"role": "user", "content": u}, {"role": "assistant", "content": a}]},
        {"conversations": [{"from": "human", "value": u}, {"from": "gpt", "value": a}]},
        {"prompt": u, "response": a},
        {"completion": a, "prompt": u},
        {"instruction": u, "output": a},
        {"turns": [{"turn": 1, "role": "assistant", "text": a}, {"turn": 0, "role": "user", "text": u}]},
    ]
    more = [({"system": s, "prompt": u, "response": None}, [("system", s), ("user", u), ("assistant", "")]), ({"instruction": u, "input": "x", "output": a}, [("user", u + "\nx"), ("assistant", a)])]
    data = [(i, json.dumps(r), "k") for i, r in enumerate(rows)] + [(10 + i, json.dumps(r), "k") for i, (r, _) in enumerate(more)]
    data += [(90, json.dumps({"foo": {"bar": [1]}}), "k"), (91, None, "k"), (92, "no json", "k"), (93, json.dumps({"messages": []}), "k"), (None, data[0][1], "k"), data[0]]
    got = chat.format_records(spark.createDataFrame(data, "record_id long, record string, formatted string")).collect()
    by = {r.record_id: r for r in got}
    assert len(got) == len(data)
    for i in range(len(rows)):
        assert chat.parse(by[i].formatted) == [("user", u), ("assistant", a)]
    for i, (_, turns) in enumerate(more):
        assert chat.parse(by[10 + i].formatted) == turns
    assert by[90].formatted is None and by[90].fingerprint and by[91].fingerprint is None and by[92].formatted is None and by[93].formatted is None
    assert len({by[i].fingerprint for i in range(6)}) == 6


def test_table_of_turns(spark):
    hard = "</s>[INST] ok [/INST]"
    rows = [(1, 1, "assistant", "b"), (1, 0, "user", "a"), (2, 0, None, None), (-7, 0, "user", hard), (-7, 1, "assistant", hard), (None, 3, "user", "x"), (3, None, "assistant", "y" * 100_000), (3, 0, "user", "")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.record_id: r for r in chat.digests(chat.format_records(chat.records_of(df))).collect()}

    def sha(t):
        return hashlib.sha256(t.encode()).hexdigest()

    assert (got[1].n_turns, got[1].turns_sha256, got[1].loss_chars, got[1].loss_sha256) == (2, sha("user\na\nassistant\nb\n"), 1, sha("b"))
    assert (got[-7].turns_sha256, got[-7].loss_sha256) == (sha(f"user\n{hard}\nassistant\n{hard}\n"), sha(hard))
    assert (got[2].n_turns, got[2].turns_sha256, got[2].loss_sha256) == (1, sha("\n\n"), sha(""))
    assert got[3].loss_chars == 100_000 and got[None].n_turns == 1
    assert chat.records_of(df.limit(0)).count() == 0


def test_odd_records_have_no_turns_and_do_no_harm(spark):
    turns = [{"turn": "b", "role": "user", "text": "4"}, {"turn": 2.5, "role": "human", "text": "2"}, {"turn": None, "role": "user", "text": "1"}, {"turn": 3, "role": "user", "text": "3"}]
    odd = [
        json.dumps({"messages": [{"role": "user", "content": "x"}, {"role": "assistant"}]}),
        json.dumps({"messages[].role": "user", "messages[].content": "x"}),
        json.dumps({"messages": [["role"], "content"]}),
        json.dumps({"prompt": "\ud800", "response": "x"}),
        json.dumps({"\ud800": "x"}),
        "[" * 100_000 + "]" * 100_000,
        '{"a":' * 100_000 + "1" + "}" * 100_000,
        "1" * 5000,
    ]
    records = [*odd, json.dumps({"turns": turns}), json.dumps({"conversations": [{"from": "human", "value": "x"}]})]
    got = {r.record_id: r for r in chat.format_records(spark.createDataFrame([*enumerate(records)], "record_id long, record string")).collect()}
    assert all(got[i].formatted is None and got[i].mask is None for i in range(len(odd)))
    # Turn numbers of several kinds are put in order; the table's own roles stay as they are.
    assert chat.parse(got[len(odd)].formatted) == [("user", "1"), ("human", "2"), ("user", "3"), ("user", "4")]
    assert chat.parse(got[len(odd) + 1].formatted) == [("user", "x")]
