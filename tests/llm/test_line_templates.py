from __future__ import annotations

import re
from collections import Counter, defaultdict

from rolescope.llm.line_templates import line_templates

from .conftest import frame


def brute(rows, min_docs=5):
    lines = {}
    for _, t, _ in rows:
        for n, line in enumerate((t or "").split("\n")):
            words = [w for w in re.split(r"[ \t\r\f\x0B]+", line) if w]
            if words:
                lines[t or "", n] = ["<*>" if re.search("[0-9]", w) else w for w in words]
    texts, leaves = defaultdict(set), defaultdict(set)
    for (t, _), tokens in lines.items():
        texts[tuple(tokens)].add(t)
        leaves[(len(tokens), *tokens[:3])].add(tuple(tokens))
    goes = {kind for kind, found in texts.items() if len(found) >= min_docs}
    for kinds in leaves.values():
        heads = Counter(kind[3:4] for kind in kinds)
        branches = defaultdict(list)
        for kind in kinds:
            if len(kind) > 3:
                branches[kind[3] if heads[kind[3:4]] >= min_docs else None].append(kind)
        for members in branches.values():
            fixed = {}
            for pos in range(3, len(members[0])):
                count, token = max((c, w) for w, c in Counter(m[pos] for m in members).items())
                if count >= 0.5 * len(members) and count > 1:
                    fixed[pos] = token
            follow = [m for m in members
                      if sum(m[p] == w for p, w in fixed.items()) >= 0.6 * (len(m) - 3)]
            if len(set().union(*(texts[m] for m in follow))) >= min_docs:
                goes |= set(follow)
    gone = {at for at, tokens in lines.items() if tuple(tokens) in goes}
    out = []
    for i, t, _ in rows:
        every = (t or "").split("\n")
        kept = [line for n, line in enumerate(every) if (t or "", n) not in gone]
        out.append((i, len(every), len(every) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def test_templates_match_brute_force(spark, docs, corpus):
    rows = list(corpus)
    for i in range(12):
        rows.append((1000 + i, f"GET /page/{i} by user{i} took {i * 7} ms\nown line {'abc'[i % 3]}"
                               f"\nLicensed under terms of {['x', 'y'][i % 5 == 0]}\n\n", "log"))
    rows += [(2000 + i, "copied line one two\ncopied line three four five", "c") for i in range(9)]
    rows.append((None, "GET /page/9 by user9 took 1 ms", None))
    got = sorted(map(tuple, line_templates(frame(spark, rows)).collect()), key=repr)
    assert got == brute(rows)
    dropped = {r[0]: r[2] for r in got}
    assert dropped[1003] >= 2 and dropped[None] == 0 or dropped[1003] >= 2
    assert all(dropped[2000 + i] == 0 for i in range(9))  # copies alone do not recur


def dropped(spark, texts):
    rows = [(i, t, "s") for i, t in enumerate(texts)]
    got = {r[0]: r[2] for r in line_templates(frame(spark, rows)).collect()}
    assert got == {i: n for i, _, n, _ in brute(rows)}
    return [got[i] for i in range(len(texts))]


def test_unique_lines_of_a_leaf_stay(spark):
    """The leading tokens lead to the leaf; they say nothing about the rest of the line."""
    ends = ["red cold", "blue warm", "old pale", "new dark", "thin loud", "tall calm"]
    assert dropped(spark, [f"It was a {e}" for e in ends]) == [0] * 6
    # two tokens of five agree beyond the depth: less than the similarity
    assert dropped(spark, [f"It was a day of {e} {e[::-1]}" for e in ends[:4]]) == [0] * 4


def test_several_boilerplates_share_a_leaf(spark):
    """Lines that recur word for word go, whichever other lines reach their leaf."""
    tails = ["terms before you use any of it", "note that came with this very box",
             "manual if the lamp does not glow"]
    assert dropped(spark, [f"please read the {tails[i % 3]}\nown {chr(97 + i)} text" for i in
                           range(30)]) == [1] * 30


def test_branches_have_templates_of_their_own(spark):
    """Two templates of a leaf that differ from the next token on, each with a variable word."""
    names = ["ann", "bob", "cleo", "dora", "emil", "fay"]
    logs = [f"the server said connection of {n} closed by peer" for n in names]
    logs += [f"the server said request from {n} took too long" for n in names]
    logs += ["the server said other things that nobody else says"]
    assert dropped(spark, logs) == [1] * 12 + [0]


def test_long_tokens_and_lines(spark):
    """One token of 200,000 characters and a line of 60,000 words are masked and compared whole."""
    lines = ["x" * 200_000, "w " * 60_000 + "end", "a" * 100_000 + "7 b"]
    assert dropped(spark, [f"{line}\nalone {'abcdef'[i]}" for i in range(6) for line in lines]) \
        == [1] * 18


def test_empty(empty_docs):
    assert line_templates(empty_docs).count() == 0


def test_only_jvm_operators(docs, capsys):
    line_templates(docs).explain()
    plan = capsys.readouterr().out
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
