from flowstat.llm.line_dedup import dedup_lines

from .helpers import empty, nasty


def expected(docs):
    """(doc_id, text) with distinct ids -> what is left, by a scan in id order."""
    seen, out = set(), {}
    for i, text in sorted(docs):
        lines = (text or "").split("\n") if text else []
        gone = set()
        for p in range(len(lines) - 2):
            w = tuple(lines[p:p + 3])
            if "".join(w) and w in seen:
                gone |= {p, p + 1, p + 2}
            seen.add(w)
        out[i] = (len(lines), len(gone), "\n".join(x for k, x in enumerate(lines) if k not in gone))
    return out


def test_brute_force(spark):
    import random
    rnd = random.Random(5)
    docs = [(i, "\n".join(rnd.choice(["a", "b", "c", ""]) for _ in range(rnd.randint(0, 14)))) for i in range(60)]
    docs += [(100, None), (101, ""), (102, "x\ny"), (103, "p\nq\nr\ns\np\nq\nr\ns"), (104, "\n\n\n\n")]
    got = {r.doc_id: (r.n_lines, r.n_removed, r.text) for r in dedup_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == expected(docs)


def test_nasty_and_empty(spark):
    got = dedup_lines(nasty(spark)).collect()
    assert len(got) == nasty(spark).count()
    by_id = {r.doc_id: r for r in got}
    assert by_id[10].text == "d" and by_id[-5].text == "a\nb\nc"   # the first occurrence is that of the smaller id
    assert by_id[1].text == "" and by_id[1].n_lines == 0
    assert dedup_lines(empty(spark)).count() == 0
