import re

import pytest

from threadtone.llm.substring_dedup import UNITS, without_repeats


def brute(rows, unit, least=150):
    """``key, kept text, removed spans, units`` of each (key, text); equal rows count once."""
    seen, plan = {}, {}
    order = sorted({(k is None, k or 0, t) for k, t in rows if t}, key=lambda r: r[:2])
    places = []
    for no, key, text in order:
        for m in re.finditer(UNITS[unit], text):
            norm = b" ".join(m.group().encode().lower().split())
            places.append(((no, key, m.start()), norm, (no, key, text), m.span()))
    for place, norm, doc, span in sorted(places, key=lambda p: p[0]):
        if seen.setdefault(norm, (place, doc)) != (place, doc):
            plan.setdefault(doc, []).append((span, len(norm)))
    for doc, again in plan.items():
        runs = []
        for span, size in sorted(again):
            if runs and runs[-1][-1][0][1] == span[0]:
                runs[-1].append((span, size))
            else:
                runs.append([(span, size)])
        plan[doc] = [span for run in runs if sum(n for _, n in run) >= least for span, _ in run]
    found = []
    for key, text in rows:
        spans = sorted(plan.get((key is None, key or 0, text), []))
        kept, at = "", 0
        for a, b in spans:
            kept, at = kept + text[at:a], b
        kept = None if text is None else kept + text[at:]
        found.append((key, kept, spans, len(re.findall(UNITS[unit], text or ""))))
    return sorted(found, key=repr)


def got(df):
    rows = df.select("doc_id", "text", "removed", "n_units").collect()
    return sorted(((r.doc_id, r.text, [(s.start, s.stop) for s in r.removed], r.n_units) for r in rows), key=repr)


@pytest.mark.parametrize("unit", sorted(UNITS))
@pytest.mark.parametrize("least", [0, 150])
def test_against_brute_force(spark, texts, unit, least):
    line = "This line of seven words comes often.\n"
    rows = [*texts.items(), (900, line * 3 + "End. " + line.upper()), (901, "\n\n" + line + "\n\n" + line), (902, line)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert got(without_repeats(docs, unit=unit, min_bytes=least)) == brute(rows, unit, least)


def test_a_passage_goes_whole_and_a_phrase_stays(spark):
    said = "Yes. No. He went out. It was late by then.\nA cold wind came from the hills. So. The road was empty. "
    said += "Nobody saw the two of them go. By noon there was snow."
    blankless = "\u4e00\u4e8c\u4e09\u56db\u4e94\u516d\u4e03\u516b" * 12
    rows = [(1, "One. " + said + " Two."), (2, "Another. " + said + " Word."), (3, "He went out. Apart. So. Not this. Yes.")]
    rows += [(4, blankless), (5, "x\n" + blankless)]
    kept = {r.doc_id: r.text for r in without_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert kept == {1: rows[0][1], 2: "Another. Word.", 3: rows[2][1], 4: blankless, 5: "x\n"}


@pytest.mark.parametrize("pattern", UNITS.values())
def test_units_make_up_the_text(pattern, texts):
    for text in [*texts.values(), "", "\n", "..", "a\n\n\nb. c\n", "?!a\n b"]:
        assert "".join(re.findall(pattern, text)) == text


def test_odd_rows(odd_docs, no_docs):
    rows = [tuple(r) for r in odd_docs.select("doc_id", "text").collect()]
    found = without_repeats(odd_docs.drop("removed", "n_units"))
    assert found.columns == [*odd_docs.drop("removed", "n_units").columns, "n_units", "removed"]
    assert got(found) == brute(rows, "sentence")
    others = [c for c in odd_docs.columns if c not in ("text", "removed", "n_units")]
    assert found.select(*others).exceptAll(odd_docs.select(*others)).count() == 0
    assert without_repeats(no_docs.drop("removed", "n_units")).collect() == []
