"""Views of a dialogue against a plain rendering."""

from croptide.llm import chat

TURNS = "conv_id long, turn long, role string, text string"


def plain(rows):
    """Per conversation and participant: the rendered text and the masked parts."""
    out = {}
    for conv in {r[0] for r in rows}:
        own = sorted(((r[1] is None, r[1] or 0, (r[2] or "").strip(" ") or "unknown", r[3] or "")
                      for r in rows if r[0] == conv))
        for me in {r[2] for r in own} - {"system"}:
            text, masks = "", []
            for _, _, who, said in own:
                head = ("assistant" if who == me else "system" if who == "system"
                        else f"user name={who}")
                text += f"<|im_start|>{head}\n"
                if who == me:
                    masks.append((len(text), len(text) + len(said) + len("<|im_end|>")))
                text += said + "<|im_end|>\n"
            out[conv, me] = (text, masks)
    return out


def found(spark, rows, extra=""):
    frame = spark.createDataFrame(rows, TURNS + extra)
    return {(r["conv_id"], r["perspective"]): (r["rendered"], [tuple(m) for m in r["masks"]])
            for r in chat.render(chat.rotate(frame)).collect()}


def test_views(spark):
    rows = [(1, 0, "system", "Be kind."), (1, 1, "alice", "Hi é"), (1, 2, "bob", "Hello\nyou"),
            (1, 3, "carol", ""), (1, 4, "alice", "Bye 👍"), (2, 0, "user", "Q"),
            (2, 1, "assistant", "A")]
    assert found(spark, rows) == plain(rows)
    masked = plain(rows)[1, "alice"]
    assert [masked[0][a:b] for a, b in masked[1]] == ["Hi é<|im_end|>", "Bye 👍<|im_end|>"]


def test_long_conversation_over_many_spans(spark, monkeypatch):
    monkeypatch.setattr(chat, "SPAN", 7)
    rows = [(9, i, f"p{i % 3}", "x" * (i % 11)) for i in range(-20, 300)]
    rows += [(9, 50, "p1", "again")] * 2
    # Very many messages of one turn, and without a turn.
    rows += [(7, turn, f"p{i % 2}", "y" * (i % 5)) for turn in (3, None) for i in range(50)]
    assert found(spark, rows) == plain(rows)


def test_odd_rows(spark):
    rows = [(None, 0, "a", "x"), (None, None, None, None), (3, 0, "system", "alone"),
            (4, None, "a", "late"), (4, 2, " ", "b"), (4, 2, "a", "b"), (4, 2, "a", "b")]
    assert found(spark, [(*r, 1, "n") for r in rows], ", position int, name string") == plain(rows)
    assert chat.rotate(spark.createDataFrame([], TURNS)).count() == 0
