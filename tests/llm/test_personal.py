import random

from murmurate.llm import personal as p

GIVEN, FAMILY = ["Mirel", "Tovan", "Asel", "Brin", "Will"], ["Quandale", "Ostrivane", "O'Brackly", "Vell-Marsh"]


def corpus(n=600, seed=1):
    """Messages with known places of personal data, names and numbers made up."""
    rng = random.Random(seed)
    rows, truth = [], set()

    def put(kind, before, value, after):
        i = len(rows)
        rows.append((i, before + value + after, "clash"))
        if kind:
            truth.add((i, kind, len(before)))

    for _ in range(n):
        g, f = rng.choice(GIVEN), rng.choice(FAMILY)
        name = rng.choice([f"{g} {f}", f"{g} {rng.choice('ABC')}. {f}", f"{f}, {g}", f"{g[0]}. {f}", f"{g} {f}".lower(), f"{g} {f}".upper()])
        put("name", *rng.choice([("forwarded by ", name, ": it is down"), ("my name is ", name, " by the way"), ("cc ", name, "")]))
        plain = "".join(rng.choice("0123456789") for _ in range(10))
        phone = rng.choice([plain, f"+1 {plain[:3]} {plain[3:6]} {plain[6:]}", f"({plain[:3]}) {plain[3:6]}-{plain[6:]}"])
        put("phone", *rng.choice([("call ", phone, " after six"), ("text me on ", phone, " if it is down")]))
        nine = f"9{plain[:8]}"
        put("id_number", *rng.choice([("passport no. ", rng.choice([nine, f"{nine[:3]}-{nine[3:5]}-{nine[5:]}"]), " got saved"), ("SSN ", rng.choice([nine, "QQ 12 34 56 A"]), " shows up")]))
        put("email", "é write to ", rng.choice(["a.b@mail.example.org", "a.b(at)mail(dot)example", "a-b at mail dot example"]), " please")
        put("address", "i live at ", rng.choice(["12 Old Mill Road, Flat 3", "7 old mill lane", "P.O. Box 77", "Calle del Olmo 3", "5 bis, rue du Puits", "Lindenstraße 4"]), " so far")
        other = "".join(rng.choice("0123456789") for _ in range(10))
        put(None, "pid 5 eats ", other, " cycles")
        put(None, "inode ", other[1:], " is orphaned")
        put(None, "the ", "Will Power", " theme breaks")
        put(None, "the icon is called ", "panel@2x.png", " and lives")
        put(None, *rng.choice([("Mount Drive ", "64 On The Other Court", " Side Of The Lab"), ("MOUNT DRIVE ", "44 ON THE OTHER COURT", " SIDE"), ("mount drive ", "24 on the other court", " side")]))
        put(None, "i was on the road to ", "64 bit", " when it broke")
    return rows, truth


def test_found_against_planted(spark):
    rows, truth = corpus()
    df = spark.createDataFrame(rows + [(10_000, None, ""), (10_001, "", ""), (None, "call +1 212 555 0100", "")], "row_id long, text string, kind string")
    found = p.find_personal(df.repartition(5), ["router"])
    got = {(r.row_id, r.kind, r.start_pos) for r in found.collect()}
    for kind in p.KINDS:
        t, g = {x for x in truth if x[1] == kind}, {x for x in got if x[1] == kind}
        assert len(t & g) / len(t) > 0.97, (kind, sorted(t - g)[:5])
        assert len(t & g) / max(len(g), 1) > 0.97, (kind, sorted(g - t)[:5])
    out = {r.row_id: r.text for r in p.redact(df.where("row_id IS NOT NULL"), found).collect()}
    assert out[3] == "é write to [EMAIL] please" and out[10_000] is None and out[10_001] == ""


def test_small_tables_and_forms_without_a_shape(spark):
    """Few rows, and of each kind the forms that no shape makes unmistakable: only patterns can find them."""
    rows, truth = corpus(40, seed=3)
    text = {i: t for i, t, _ in rows}
    got = {(r.row_id, r.kind, r.start_pos) for r in p.find_personal(spark.createDataFrame(rows, "row_id long, text string, kind string"), []).collect()}
    sure = {(i, kind, a) for i in text for kind, _, strong, a, _ in p._spans(text[i]) if strong}
    for kind in ("name", "phone", "id_number"):
        plain = {x for x in truth if x[1] == kind} - sure
        assert len(plain) >= 8 and len(plain & got) / len(plain) > 0.9, (kind, sorted(plain - got)[:5])
    assert len(got - truth) / len(got) < 0.03, sorted(got - truth)[:5]


def test_a_strong_shape_is_judged_too(spark):
    """A seed whose shape and surroundings are otherwise refused is not found; the graph decides on seeds as on others."""
    c = [(i, "phone", 0, 1, f"p{i}", True, None, None, ["l1 call", "r1 now", "sh 1"]) for i in range(5)]
    c += [(9, "phone", 0, 1, "odd", True, None, None, ["l1 pid", "l2 the pid", "r1 eats", "r2 eats cycles", "lr pid _ eats", "sh 2"])]
    c += [(20 + i, "phone", 0, 1, f"w{i}", False, None, None, ["l1 pid", "l2 the pid", "r1 eats", "r2 eats cycles", "lr pid _ eats"]) for i in range(40)]
    c += [(80 + i, "phone", 0, 1, f"s{i}", False, None, None, ["sh 2"]) for i in range(9)]
    got = {r.instance for r in p.score_graph(spark.createDataFrame(c, p._CANDIDATE), p.Scratch(spark, "t")).collect()}
    assert got == {f"p{i}" for i in range(5)}


def test_empty_and_repeated_rows(spark):
    ddl = "row_id long, text string"
    assert p.find_personal(spark.createDataFrame([], ddl), []).count() == 0
    df = spark.createDataFrame([(1, "call +1 212 555 0100 now"), (2, "call +1 212 555 0100 now"), (3, "x" * 200_000 + " call +1 212 555 0100")], ddl)
    assert sorted((r.row_id, r.start_pos) for r in p.find_personal(df, []).collect()) == [(1, 5), (2, 5), (3, 200_006)]


def test_name_shapes():
    r = p._Reader(())
    text = "ask Mirel B. Quandale, not Ostrivane, Asel"
    spans = {text[t[a][1] : t[b][2]] for t in [r.tokens(text, [])] for a, b, *_ in p._names(t)}
    assert {"Mirel B. Quandale", "Ostrivane, Asel", "B. Quandale"} <= spans
