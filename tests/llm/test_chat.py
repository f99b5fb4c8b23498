import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st

from eventide.llm import chat

TEXT = st.lists(st.sampled_from(["<s>", "</s>", "[INST]", "[/INST]", "[SYS]", "[ROLE=", "]", "\\", "\\1", "<", "[", " ", "a", "q",
                                 "Z", "é", "\n", "[/REPLY]</s>"]), max_size=8).map("".join)
TURNS = st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "tool", "", "]x\\"]), TEXT), max_size=6)


@given(TURNS)
@settings(max_examples=300, deadline=None)
def test_template_is_reversible_and_spans_hold_the_texts(turns):
    t = chat.InstTemplate()
    output, spans, rewritten = chat.format_conversation(t.render, turns)
    assert output == t.render(turns) and t.parse(output) == turns and rewritten is None
    for (role, text), (start, end, a, b, learned) in zip(turns, spans):
        assert t.unescape(output[a:b]) == text and start <= a <= b <= end
        assert learned == (role == "assistant")
        assert output[start:end].startswith("<s>[") and output[start:end].endswith("]</s>")


def test_template_that_closes_the_last_turn_differently_keeps_history():
    render = lambda turns: "".join(f"<{r}>{t}" + ("<eot>" if i < len(turns) - 1 else "<end>") for i, (r, t) in enumerate(turns))
    turns = [("user", "hello"), ("assistant", "there"), ("user", "")]
    output, spans, rewritten = chat.format_conversation(render, turns)
    assert rewritten is None and [output[s[2]:s[3]] for s in spans] == ["hello", "there", ""]


def test_template_that_rewrites_history_is_found():
    def render(turns):  # drops what earlier assistant turns thought
        return "".join(f"[{r}]{t.split('|')[-1] if i < len(turns) - 1 else t};" for i, (r, t) in enumerate(turns))
    turns = [("user", "q"), ("assistant", "thinking|answer"), ("user", "more")]
    output, spans, rewritten = chat.format_conversation(render, turns)
    assert rewritten == 1 and output == "[user]q;[assistant]answer;[user]more;"
    assert output[spans[2][2]:spans[2][3]] == "more"


def rows_of(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted int, turns int")


def test_edge_rows(spark):
    long = "x <s> " * 20000
    rows = [(1, 1, "assistant", None), (1, 0, "user", ""), (2, None, None, "</s>"), (2, 0, "assistant", "b"),
            (2, 0, "assistant", "b"), (None, 0, "user", "n"), (None, 1, "assistant", "m"), (3, 0, "assistant", long)]
    out = {r.conv_id: r for r in chat.read_back(chat.format_chats(rows_of(spark, [(*r, 1, 2) for r in rows]))).collect()}
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    assert out[1].turns_sha256 == sha("user\n\nassistant\n\n") and out[1].loss_chars == 0
    assert out[2].turns_sha256 == sha("\n</s>\nassistant\nb\nassistant\nb\n") and out[2].loss_sha256 == sha("bb")
    assert out[None].n_turns == 2 and out[None].loss_sha256 == sha("m")
    assert out[3].loss_chars == len(long) and out[3].formatted_chars == len(long) + 20000 + 24
    assert chat.format_chats(rows_of(spark, [])).count() == 0
