import random
import re

from eventlake.llm import lines
from eventlake.llm.lines import UnitConfig


def normal(unit):
    return " ".join(w.decode() for w in unit.encode().lower().split())


def brute(listed, min_words=1, sentence_words=5):
    """Per row: the kept text and the numbers of lines and removals, character by character. Rows with equal id and text are one document."""
    ordered = sorted({(i is None, i or 0, t) for i, t in listed if t}, key=lambda r: r[:2])
    first, gone, split = set(), {}, {}
    for own in ordered:
        text, marks = own[2], []
        for k, line in enumerate(text.split("\n")):
            marks += [k] * len(line) + [None]
        ends, which = [m.end() for m in re.finditer(r"[.!?][ \t-\r]+", text)], []
        which = [sum(e <= p for e in ends) for p in range(len(text))] if len(text) < 10_000 else [0] * len(text)
        split[own] = marks, which
        sentences = ["".join(c for c, w in zip(text, which) if w == k) for k in range(len(ends) + 1)] if len(text) < 10_000 else [text]
        for level, least, units in (("line", min_words, text.split("\n")), ("sentence", sentence_words, sentences)):
            for k, unit in enumerate(units):
                key = level, normal(unit)
                if key[1] and len(key[1].split(" ")) >= least > 0:
                    if key in first:
                        gone.setdefault(own, set()).add((level, k))
                    first.add(key)
    out = []
    for i, text in listed:
        own = (i is None, i or 0, text)
        drop = gone.get(own, set())
        if not drop:
            out.append((i, len(text.split("\n")) if text else 0, 0, text))
            continue
        marks, which = split[own]
        lines, touched = {}, set()
        for c, line, sentence in zip(text, marks, which):
            if line is not None and ("line", line) not in drop:
                if ("sentence", sentence) in drop:
                    touched.add(sentence)
                else:
                    lines[line] = lines.get(line, "") + c
        n = len(text.split("\n"))
        kept = "\n".join(lines.get(k, "") for k in range(n) if ("line", k) not in drop)
        out.append((i, n, sum(level == "line" for level, _ in drop) + len(touched), kept))
    return sorted(out, key=repr)


def got(frame):
    return sorted(((r.doc.doc_id, r.n_units, r.n_removed, r.kept) for r in frame.collect()), key=repr)


A, B = "This line is in many documents", "  this   LINE is in\tmany documents "


def test_earliest_line_stays(documents):
    listed = [(3, f"{A}\nown line of document number three"), (1, f"first line of the one\n{B}\nend"), (2, A), (4, f"{A}\n{A}\nshort one"), (5, "short one")]
    assert got(lines.cleaned(documents(*listed), ["doc_id"])) == brute(listed)


def test_hard_documents(hard_docs, hard_rows):
    listed = [r[:2] for r in hard_rows if r[0] != 8]  # one id with two texts is ranked by a hash
    assert got(lines.cleaned(hard_docs.where("doc_id IS NULL OR doc_id <> 8"), ["doc_id"])) == brute(listed)


def test_offsets(documents):
    text = f"é start of the whole thing\n{A}\n\U0001f600 and then the end comes"
    rows = lines.cleaned(documents((1, A), (2, text)), ["doc_id"]).collect()
    (row,) = [r for r in rows if r.doc.doc_id == 2]
    assert [text[s.start : s.end] for s in row.removed] == [A]
    assert "\n".join(text[s.start : s.end] for s in row.stayed) == row.kept


def test_paragraphs(documents):
    one, two = "a b c d e\nf g h i j", "k l m n o\np q r s t"
    rows = lines.cleaned(documents((1, f"{one}\n\n{two}"), (2, f"{two}\n\nx {one}")), ["doc_id"], UnitConfig(separator="\n\n")).collect()
    assert {r.doc.doc_id: r.kept for r in rows} == {1: f"{one}\n\n{two}", 2: f"x {one}"}


def test_columns_stay(hard_docs, clashing):
    docs = clashing(hard_docs)
    out = lines.without_repeats(docs)
    assert out.columns == docs.columns and out.count() == docs.count()


def test_empty_table(documents):
    assert lines.removal_report(documents()).count() == 0


def test_short_lines_go_too(documents):
    listed = [(1, "All rights reserved.\nshort\n\n \n"), (2, "all RIGHTS  reserved.\n\nown line"), (3, "short\nshort\n\nend")]
    assert got(lines.cleaned(documents(*listed), ["doc_id"])) == brute(listed)
    assert got(lines.cleaned(documents(*listed), ["doc_id"], UnitConfig(min_words=3))) == brute(listed, 3)


def test_passages_inside_lines(documents):
    passage = "It was the best of times, it was the worst. We had it all before us! Nothing was left?"
    wrapped = passage.replace("the worst. We", "the\nworst.\n  We")
    listed = [(1, f"Own start. {passage} Own end."), (2, f"Something else here.\nLead in. {wrapped} Tail."), (3, wrapped), (4, f"He ran. {passage}\nHe ran. end")]
    rows = lines.cleaned(documents(*listed), ["doc_id"])
    assert got(rows) == brute(listed)
    kept = {r.doc.doc_id: r.kept for r in rows.collect()}
    assert kept[1] == listed[0][1] and "best of times" not in "".join(kept[i] for i in (2, 3, 4))
    for r in rows.collect():
        text = dict(listed)[r.doc.doc_id]
        assert "".join(text[s.start : s.end] for s in r.stayed) == r.kept.replace("\n", "")
        assert not set().union(*[range(s.start, s.end) for s in r.stayed]) & set().union(*[range(s.start, s.end) for s in r.removed])


def test_no_sentences_on_demand(documents):
    listed = [(1, "One sentence with many words here. And then own text"), (2, "One sentence with many words here. And other text")]
    assert got(lines.cleaned(documents(*listed), ["doc_id"], UnitConfig(sentence_words=0))) == brute(listed, 1, 0)
    assert got(lines.cleaned(documents(*listed), ["doc_id"])) == brute(listed) != brute(listed, 1, 0)


def test_made_texts_against_brute_force(documents):
    rng = random.Random(4)
    known = [" ".join(rng.choice("abcde") for _ in range(rng.randrange(1, 9))) + rng.choice([".", "!", "", "?!"]) for _ in range(30)]
    listed = [(i, "".join(rng.choice(known) + rng.choice([" ", "\n", "  ", " \n ", "\n\n"]) for _ in range(rng.randrange(12)))) for i in range(120)]
    assert got(lines.cleaned(documents(*listed), ["doc_id"])) == brute(listed)
