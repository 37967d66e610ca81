import pytest

from rollcall.llm.names import NOBODY, OPERATIONS, Typed, attribute_names, channel_costs, cost, distance, parse, person, person_keys, typed_keys

PEOPLE = [(1, "Elizabeth Kenneth Kivvasssky", "Elizabeth", "Kenneth", "Kivvasssky", "", "6"), (2, "Timothy Jennifer Kivvasssky", "Timothy", "", "", "", "9"), (3, "Jacqueline Robert Daiklurpu Jr.", "", "", "", "Jr.", "69"),
          (4, "Jacqueline Pamela Daiklurpu Sr.", "", "", "", "Sr.", "14"), (5, "José Flussheathin", "", "", "", None, "80"), (6, "Xavier Harold de la Stiothberg", "Xavier", "Harold", "", "", "1"),
          (7, "Samuel Biockdriorna-Hairstou", None, "Vera", None, None, None), (8, "William O'Gainprieze", "William", "Charles", "O'Gainprieze", "", "3"), (9, "Vera Bussky", "", "", "", "", "11")]
TYPED = {"Eli. Kivvasssky (R)": 1, "KIVVASSSKY, LIZ": 1, "T. J. Kivvasssky": 2, "Representative Daiklurpu Jr.,Jacqueline R.": 3, "REP. JACQUELINE P. DAIKULRPU SR.": 4, "Rep. Jose Flussheathin": 5, "Flusheathin, Pepe": 5,
         "X. de la Stiothberg": 6, "Stiothberg Xavier H.": 6, "BiockdriornaeHairstou,Samuel V.": 7, "Sam Hairstou": 7, "Bill O’Gainprieze of Sable Creek": 8, 'William "Bill" OGainpreize': 8, "Bussky, Vee": 9, "  Vera\xa0Bussky ": 9,
         "Ms. Bussky": 9, "Vera Bussky": 9, "Vera Busk., D-11": 9}
NOBODY_TYPED = ["VACANT", "(vacancy)", "", "   ", None, "House Cmte on Aging", "Zachary Bussky", "Quincy Unrelated", "x" * 3000, ",", ".", "(R)", "Daiklurpu, J. II"]


@pytest.mark.parametrize("typed,number", TYPED.items())
def test_likelihoods(typed, number):
    ranked = sorted((cost(parse(typed), person(*(x or "" for x in p[1:6]))), p[0]) for p in PEOPLE)
    assert ranked[0][1] == number and ranked[0][0][0] <= NOBODY and ranked[1][0][0] - ranked[0][0][0] > 0.05
    assert Typed.of(parse(typed).form()) == parse(typed)
    assert typed_keys(parse(typed)) & person_keys(person(*(x or "" for x in PEOPLE[number - 1][1:6])))


def test_distance():
    assert [distance(*x) for x in (("abc", "abc", 2), ("abc", "acb", 2), ("abc", "ab", 2), ("abcd", "badc", 2), ("abc", "xyz", 2))] == [0, 1, 1, 2, 3]


def test_attribution(spark):
    people = spark.createDataFrame([("J", "S", *p) for p in PEOPLE] + [("K", "S", 50, "Vera Bussky", "", "", "", "", "")],
                                   "j string, s string, number long, full_name string, given string, middle string, family string, suffix string, district string")
    typed = [("J", "S", n, None, None) for n in [*TYPED, *NOBODY_TYPED]] * 2 + [("K", "S", "Bussky, V.", "0", None), (None, "S", "Vera Bussky", None, None), ("J", "S", "Kivvasssky", " 009 ", None), ("J", "S", "Called Otherwise", None, 5)]  # a column of another name isn't read
    df = spark.createDataFrame(typed, "j string, s string, name string, district string, hint long")
    out = attribute_names(df, people, ["j", "s"], "name", "number").collect()
    got = {(r.j, r.name): r.number for r in out}
    assert len(got) == len(out)
    assert got == {("J", n): p for n, p in TYPED.items()} | {("K", "Bussky, V."): 50, ("J", "Kivvasssky"): 2}
    assert attribute_names(df.filter("false"), people, ["j", "s"], "name", "number").collect() == []
    assert attribute_names(df, people.filter("false"), ["j", "s"], "name", "number").collect() == []


def test_prior_and_costs_come_from_the_data(spark):
    people = spark.createDataFrame([("J", i, n, "", "", "", "", "") for i, n in enumerate(["Ann Torvik", "Amy Torvik", "Carl Mostaza", "Dora Quimby"])], "j string, no string, full_name string, given string, middle string, family string, suffix string, district string".replace("no string", "no int"))
    rows = [("J", "Ann Torvik")] * 50 + [("J", "Amy Torvik"), ("J", "A. Torvik"), ("J", "Mostaza, Carl")]
    df = spark.createDataFrame(rows, "j string, name string")
    got = {r.name: r.no for r in attribute_names(df, people, ["j"], "name", "no").collect()}
    assert got == {"Ann Torvik": 0, "Amy Torvik": 1, "A. Torvik": 0, "Mostaza, Carl": 2}  # both fit, one is written about more
    without = {r.name for r in attribute_names(df, people, ["j"], "name", "no", prior_weight=0.0).collect()}
    assert without == {"Ann Torvik", "Amy Torvik", "Mostaza, Carl"}
    found = spark.createDataFrame([(i, 1, 0.0, 1 << 8) for i in range(3000)] + [(9000, 1, 2.6, 1), (9001, 1, 2.6, 1), (9001, 2, 2.7, 1)], "sid long, pid long, first double, operations long")
    costs = channel_costs(found)
    assert costs["initial"] < OPERATIONS["initial"] and costs["edit"] > OPERATIONS["edit"]
