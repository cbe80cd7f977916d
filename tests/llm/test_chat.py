import random
import re
from collections import defaultdict

from tidewell.llm import chat, common
from tidewell.llm.chat import link_quotes

SCHEMA = "conv_id long, turn long, role string, text string, position string"


def links(spark, rows):
    out = link_quotes(spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)).collect()
    return {(r.conv_id, r.turn): r for r in out}


def test_links_and_order(spark):
    rows = [
        (1, 0, "user", "How do I sort?\n\nAnd how do I join?"),
        (1, 1, "assistant", "Use orderBy\non the frame."),
        (1, 2, "user", "On Monday A wrote:\n> How do I sort?\nMe too."),
        (1, 3, "user", "> > and how do i\n> > join?\n> Me  too.\nThanks"),
        (1, 4, "user", "> > And how do I join?\n> Use orderBy on the frame.\nWorks"),
        (1, 5, "user", "> never said\nHm"),
        (2, 0, "user", "How do I sort?"),
        (2, 1, "user", "plain"),
    ]
    got = links(spark, rows)
    assert got[1, 2].reply_to == 0 and got[1, 2].text == "Me too." and got[1, 2].n_linked == 1
    assert got[1, 3].reply_to == 2 and got[1, 3].depth == 2 and got[1, 3].text == "Thanks"
    assert (got[1, 3].n_quotes, got[1, 3].n_linked) == (4, 2)  # two lines and their passage of level 2, one line of level 1
    assert got[1, 4].reply_to == 1 and got[1, 4].n_linked == 2
    assert got[1, 5].reply_to == 4 and got[1, 5].n_linked == 0
    assert got[1, 0].reply_to is None and got[2, 1].reply_to == 0
    order = sorted((r for r in got.values() if r.conv_id == 1), key=lambda r: r.reply_order)
    assert [r.turn for r in order] == [0, 1, 2, 4, 3, 5] or [r.depth for r in order] == sorted(r.depth for r in order)
    assert sorted(r.reply_order for r in got.values() if r.conv_id == 1) == list(range(6))
    assert got[2, 0].formatted == "<|user|>\nHow do I sort?\n"


def test_odd_rows(spark):
    rows = [(None, None, None, None), (None, 1, "user", ""), (3, 0, "user", "a"), (3, 0, "user", "a"), (3, 1, "user", "> a\n" * 3000 + "b"), (4, 0, "user", "> > >\n>>\n>")]
    out = link_quotes(spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)).collect()
    assert len(out) == 6
    long = next(r for r in out if r.conv_id == 3 and r.turn == 1)
    assert long.text == "b" and long.reply_to in (0, 1) and long.n_linked == 3000
    assert link_quotes(spark.createDataFrame([], SCHEMA)).collect() == []


def test_long_chain(spark):
    rows = [(1, 0, "user", "line 0")] + [(1, t, "user", f"> line {t - 1}\nline {t}") for t in range(1, 70)]
    got = links(spark, rows)
    assert all(got[1, t].depth == t and got[1, t].reply_order == t for t in range(70))


def brute(rows):
    """One message after the other in plain Python: (position, reply_to, depth, n_quotes, n_linked, text) by conversation, in order."""
    by_conv = defaultdict(list)
    for conv, turn, role, text in rows:
        by_conv[conv].append((turn is not None, turn, role, text))
    out = {}
    for conv, messages in by_conv.items():
        messages.sort(key=lambda m: m[:2] if m[0] else (False, 0))
        known, depth, result = {}, [], []
        for at, (_, _, _, text) in enumerate(messages):
            lines = []
            for line in (text or "").split("\n"):
                marks = re.match(r"(?:[ \t]*>)+ ?|", line)[0]
                lines.append((marks.count(">"), line[len(marks) :]))
            found, run = [], []
            for level, body in [*lines, (-1, "")]:
                norm = re.sub(r"\s+", " ", body).strip(" ").lower()
                if run and (not norm or level != run[0][0]):
                    found += run + ([(run[0][0], " ".join(x for _, x in run))] if len(run) > 1 else [])
                    run = []
                if norm:
                    run.append((level, norm))
            votes, linked = defaultdict(int), 0
            for level, norm in found:
                if level > 0 and norm in known:
                    linked += 1
                    if level == 1:
                        votes[known[norm]] += len(norm)
            reply = max(votes, key=lambda k: (votes[k], k)) if votes else at - 1 if at else None
            depth.append(0 if reply is None else depth[reply] + 1)
            own = [b for i, (level, b) in enumerate(lines) if level == 0 and not (re.search(r"\bwrote:\s*$", b, re.I) and i + 1 < len(lines) and lines[i + 1][0] > 0)]
            clean = re.sub("\n{3,}", "\n\n", "\n".join(own)).strip(" ")
            result.append((at, reply, depth[-1], sum(level > 0 for level, _ in found), linked, clean))
            for level, norm in found:
                if level == 0:
                    known.setdefault(norm, at)
        out[conv] = result
    return out


def test_against_plain_python(spark, monkeypatch):
    """Random nested quotes; half of all messages lie in one conversation and most quote one message; looked up by broadcast and by shuffle."""
    rng = random.Random(6)
    rows, said = [], defaultdict(list)
    for i in range(500):
        conv = rng.choice([7, 7, 7, *range(6), None])
        turn = len(said[conv])
        own = [" ".join(rng.choices(["a", "B", "c d", "e  f", "gg"], k=rng.randint(1, 3))) for _ in range(rng.randint(0, 3))]
        lines = []
        if said[conv] and rng.random() < 0.7:
            quoted = said[conv][0 if rng.random() < 0.5 else rng.randrange(turn)]
            lines += [rng.choice(["On Monday X wrote:", "x Wrote: "])] if rng.random() < 0.5 else []
            lines += [rng.choice(["> ", ">", " > "]) + (x.upper() if rng.random() < 0.3 else x) for x in quoted.split("\n")]
        lines += [*own[:1], *rng.choice([[], [""], ["", "", ""]]), *own[1:], *rng.choice([[], ["> never said"], ["> > "], [""]])]
        text = "\n".join(lines)
        said[conv].append(text)
        rows.append((conv, turn, rng.choice(["user", "assistant"]), text))
    rows.append((9, None, "user", None))
    want = brute(rows)
    for whole in (common.BROADCAST_ROWS, 0):
        monkeypatch.setattr(chat, "look_up", lambda *a, whole=whole: common.look_up(*a, whole=whole))
        got = defaultdict(list)
        for r in link_quotes(spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)).collect():
            got[r.conv_id].append(r)
        assert {c: sorted((r.position, r.reply_to, r.depth, r.n_quotes, r.n_linked, r.text) for r in rs) for c, rs in got.items()} == {c: sorted(v) for c, v in want.items()}
        for rs in got.values():
            rs.sort(key=lambda r: r.reply_order)
            assert [r.reply_order for r in rs] == list(range(len(rs))) and [(r.depth, r.position) for r in rs] == sorted((r.depth, r.position) for r in rs)
