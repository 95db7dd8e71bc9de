import hashlib

from hypothesis import given
from hypothesis import strategies as st

from vigil.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, part long"


def test_round_trip_and_digests(spark):
    rows = [(1, t, "assistant" if t % 2 else "user", f"{t} ### x </turn>\n\\h" if t % 5 else None, 0) for t in range(75)]
    rows += [(2, 0, "assistant", "", 1), (None, None, None, None, None), (3, 0, "a: b", "x", 1), (3, 0, "a: b", "x", 1)]
    got = {r.conv_id: r for r in chat.read_back(chat.format_chats(spark.createDataFrame(rows, SCHEMA).repartition(5))).collect()}
    said = [(r or "", x or "") for c, _, r, x, _ in rows if c == 1]
    one = got[1]
    assert one.n_turns == 75 and one.history_rewrites == 0
    assert one.turns_sha256 == hashlib.sha256("".join(f"{r}\n{x}\n" for r, x in said).encode()).hexdigest()
    loss = "".join(x for r, x in said if r == "assistant")
    assert (one.loss_chars, one.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert one.formatted_chars == len(chat.template(said))
    assert got[3].n_turns == 2 and got[None].n_turns == 1 and got[2].loss_chars == 0


def test_windows_do_not_matter(spark):
    rows = [(1, t, "user", f"text {t}", 0) for t in range(40)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert len({chat.read_back(chat.format_chats(df, window=w)).drop("history_rewrites").first() for w in (1, 3, 16, 100)}) == 1


def test_detects_rewritten_history(spark):
    def forgetful(turns, continued=False):
        """Drops all but the last turn's text, as templates that strip old reasoning do."""
        return "".join(f"<{r}>{t if i == len(turns) - 1 else ''};" for i, (r, t) in enumerate(turns))

    df = spark.createDataFrame([(1, t, "assistant", "abc", 0) for t in range(4)], SCHEMA)
    assert chat.format_chats(df, render=forgetful, content=lambda x: (0, len(x))).first().rewrites == 3
    text, spans, rewrites = chat.locate(chat.template, [("user", "a"), ("assistant", "b")], False)
    assert rewrites == 0 and [text[a:b] for a, b in spans] == ["### user: a</turn>\n", "### assistant: b</turn>\n"]


def test_detects_rewrites_beyond_a_window(spark):
    def last_20(turns, continued=False):
        """Keeps the last 20 turns, as templates for a bounded context do."""
        return chat.template(turns[-20:])

    def system_last(turns, continued=False):
        """Moves the first turn into the latest."""
        return "".join(f"<{t}>" for _, t in turns[1:-1]) + f"<{turns[0][1]}|{turns[-1][1]}>"

    said = [("assistant" if t % 2 else "user", f"text {t}") for t in range(40)]
    df = spark.createDataFrame([(1, t, r, x, 0) for t, (r, x) in enumerate(said)], SCHEMA)
    (kept,) = chat.format_chats(df, render=last_20, content=lambda x: (0, len(x))).collect()
    assert (kept.turns, kept.rewrites, kept.formatted) == (40, 20, last_20(said))
    (moved,) = chat.format_chats(df, render=system_last, content=lambda x: (0, len(x))).collect()
    assert (moved.turns, moved.rewrites, moved.formatted) == (40, 39, system_last(said))
    assert chat.format_chats(df).count() == 3 and chat.read_back(chat.format_chats(df)).first().history_rewrites == 0


def test_no_rows(spark):
    assert chat.read_back(chat.format_chats(spark.createDataFrame([], SCHEMA))).count() == 0


@given(st.lists(st.tuples(st.text(), st.text()), max_size=5))
def test_escape_is_reversible(turns):
    text = chat.template(turns)
    assert [(r, chat.unescape(text[a:b])) for r, a, b in chat.parse(text)] == turns
