import hashlib

from hypothesis import given
from hypothesis import strategies as st
from lumivox.llm import chat


@given(st.text(alphabet="<|\\im_start>end\n a%0A", max_size=40), st.text(alphabet="<|\\>%\n0Auser", max_size=12))
def test_template_is_reversible(text, role):
    whole, start, end = chat.render(role, text)
    assert chat.parse(whole) == [(role, text)]
    assert chat.unescape(whole[start:end]) == text
    assert "<|" not in whole[start:end]


def expected(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1]))
        turns = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in own)
        loss = "".join(r[3] or "" for r in own if r[2] == "assistant")
        out[conv] = (len(own), hashlib.sha256(turns.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def test_conversations_read_back(spark):
    rows = [(1, 1, "assistant", "b <|im_end|>"), (1, 0, "user", "a"), (2, 0, None, None), (None, 3, "user", "é\n"), (3, None, "assistant", ""), (3, 2, "assistant", "x" * 5000)]
    rows += [(9, k, "user" if k % 2 else "assistant", f"t{k}<\\|") for k in range(300)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, seq int")
    got = chat.digest(chat.format_events(chat.conversation_events(df))).collect()
    assert {r[0]: tuple(r[1:5]) for r in got} == expected(rows)


def test_repeated_rows_are_turns_of_their_own(spark):
    df = spark.createDataFrame([(1, 0, "user", "a")] * 3, "conv_id long, turn long, role string, text string")
    assert chat.digest(chat.format_events(chat.conversation_events(df))).first()["n_turns"] == 3


def test_events_fold_deltas_edits_and_regenerations(spark):
    events = [
        (1, 0, "m", 0, "open", "assistant", None), (1, 0, "m", 1, "delta", None, "dra"), (1, 0, "m", 2, "delta", None, "ft"),
        (1, 0, "m", 3, "regenerate", None, None), (1, 0, "m", 4, "delta", None, "new "), (1, 0, "m", 5, "delta", None, "text"),
        (1, 1, "m", 0, "open", "user", "old"), (1, 1, "m", 1, "edit", None, "edited"), (1, 1, "m", 2, "delta", None, "!"),
    ]
    df = spark.createDataFrame(events[::-1], "conv_id long, turn long, msg_id string, seq long, kind string, role string, text string")
    got = chat.format_events(df).orderBy("turn").collect()
    assert [chat.parse(r["rendered"])[0] for r in got] == [("assistant", "new text"), ("user", "edited!")]
    assert got[1]["loss_start"] is None and got[0]["rendered"][got[0]["loss_start"] : got[0]["loss_end"]] == "new text"


def test_empty_log(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.digest(chat.format_events(chat.conversation_events(df))).count() == 0
