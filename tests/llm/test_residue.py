from rollcall.llm.residue import find_residue, without_residue

SCHEMA = "id long, url string, media string, text string, kind string, field string"
GOOD = "https://legis.wi.example/2020/hb1.pdf"
REAL = "The committee recessed at 7:10 and took up beekeeping after lunch. Quorum was declared at 9:15 p.m. and the clerk noted that the bill repeals raw milk sales in every county of the state."


def residue(spark, rows):
    df = spark.createDataFrame([(*r, "clash", "clash") for r in rows], SCHEMA)
    return df, find_residue(df, "id", "url", "media", "text")


BAD_TEXTS = ["A BILL {{ title }} relating to taxes.", "An Act ${year} relating to __chamber__.", "Lorem ipsum dolor sit amet.", "502 Bad Gateway nginx", "PLEASE ENABLE JAVASCRIPT TO VIEW THIS PAGE.",
             "<noscript>This site requires scripts and cookies.</noscript>", "Insert text here. Insert text here.", "<html><head><title>Server Error in '/' Application.</title></head><body>Runtime Error</body></html>",
             "A BILL FOR AN ACT relating to <insert subject>; amending section <insert section>.", "Access Denied. Reference #18.3683", "[BILL TEXT GOES HERE]", "XXXX TITLE XXXX. Section X. Section XX.",
             REAL + " It applies to %(county)s only."]
GOOD_TEXTS = [REAL, "The term “template” means a form in which a rebate number is inserted.", "<strike>shall</strike> <ins>may</ins> renew the license.", "Schools shall teach JavaScript and cookies safety.",
              "[Section 653.68 omitted] The Board [sic] keeps the rule.", "The blank reads “Name: ______” and must be filled.", "The error in section 109.76 was not found until 2001, and the page was removed.",
              "A request denied may be appealed; access denied to a hunter counts.", "Server fees and the temporarily unable worker benefit are repealed.", "", None, " \n ", "x" * 50_000,
              REAL + " The notice said: please enable JavaScript to view this page."]
BAD_URLS = ["https://a.example/{{ session }}/1.pdf", "javascript:void(0)", "https://a.example/bills/undefined/9", "https://a.example/doc?id=NaN", "https://example.com/lorem-ipsum.pdf", "https://a.example/errors/404?aspxerrorpath=/x",
            "https://a.example/bills/%7B%7Bbill%7D%7D.pdf", "https://a.example/<session>", "HTTPS://A.EXAMPLE/__DOC.URL__/X.PDF", "https://a.example/%s/%d.html"]
GOOD_URLS = [GOOD, "https://a.example/doc/{5A7B4468-F5E3-4B34-ACE8-991A5EB71819}.pdf", "https://a.example/get?doc=%7B3A292BB7-6CA1-45C4-A11A-7DB6CCB28C94%7D", "https://a.example/undefined-terms-act/1.pdf", "https://a.example/2019/404/500.xml",
             "https://a.example/~error-correction/HB_2005__v2.pdf", "https://a.example/bills/SB%208061%20(Sub)%5B2%5D.htm", "https://a.example/null-and-void-contracts/2.pdf", None, ""]
BAD_MEDIA = ["{{ media_type }}", "NULL", "text/html; error=404", "YOUR_TYPE_HERE", "#N/A", "application/<TYPE>", "[object Object];", " %s", "please enable javascript", "media/type"]
GOOD_MEDIA = ["text/html; charset=utf-8", "application/x-wais-source", "x-world/x-vrml", "", None, "TEXT/HTML", "application/vnd.openxmlformats-officedocument.wordprocessingml.document"]


def test_evidence_in_each_field(spark):
    rows, want = [], set()
    for values, field, bad in ((BAD_TEXTS, 2, 1), (GOOD_TEXTS, 2, 0), (BAD_URLS, 0, 1), (GOOD_URLS, 0, 0), (BAD_MEDIA, 1, 1), (GOOD_MEDIA, 1, 0)):
        for v in values:
            r = [GOOD, "text/html", REAL]
            r[field] = v
            rows.append((len(rows), *r))
            if bad:
                want.add((len(rows) - 1, ("url", "media", "text")[field]))
    df, out = residue(spark, rows + rows[:5])
    got = {(r.id, r.field) for r in out.collect()}
    wrong = {(rows[i][1:], f) for i, f in got ^ want}
    assert not wrong
    assert {r.id for r in without_residue(df, out, "id").collect()} == set(range(len(rows))) - {i for i, _ in want}


def test_boilerplate_is_subtracted_by_host(spark):
    wrap = lambda s: f"Wisconsin Legislature\n\n{s}\n\n" + " | ".join(["Home", "Bills", "Calendar", "Members of the house and of the senate", "Search all the statutes and rules by number and by year"] * 3)
    rows = [(i, GOOD, "", wrap(f"{REAL} Number {i}.")) for i in range(40)] + [(100, GOOD, "", wrap("Session timed out. Please return to the home page."))]
    _, out = residue(spark, rows)
    assert [(r.id, r.kind) for r in out.collect()] == [(100, "error")]


def test_empty_and_null_keys(spark):
    assert residue(spark, [])[1].collect() == []
    assert residue(spark, [(None, "javascript:void(0)", None, None)])[1].first().id is None


FRAME = ["Wisconsin Legislature", "Home | Bills | Calendar | Members of the house | Members of the senate | Search statutes | Search rules | Journals | Committees | Hearings | Reports | Archive | Contact | Help | About this site"]
PAGES = ["Session timed out.", "502 Bad Gateway", "You need to enable JavaScript to run this app."]


def framed(host, ids):
    return [(i, f"https://{host}.example/{i}.htm", "", "\n\n".join([FRAME[0], PAGES[i % 3], FRAME[1]])) for i in ids]


def test_frame_is_subtracted_whatever_the_size_of_the_table(spark):
    bills = [(1000 + i, f"https://legis.wi.example/{i}.htm", "", REAL.replace("beekeeping", f"topic {'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10 % 10]}{'uvwxyz'[i // 100]}")) for i in range(600)]
    for pages, rest in ((framed("legis.wi", range(3)), []), (framed("legis.wi", range(3)), bills), (framed("legis.wi", range(30)), bills)):
        _, out = residue(spark, pages + rest)
        assert {r.id for r in out.collect()} == {p[0] for p in pages}


def test_versions_of_a_bill_are_no_boilerplate(spark):
    text = lambda i: f"{REAL}\n{REAL.replace('beekeeping', 'the levy')} It ends.\nVersion {i}\nPlease enable JavaScript to view this page."
    _, out = residue(spark, [(i, GOOD, "", text(i)) for i in range(25)])
    assert out.collect() == []


def test_notices_are_learnt_from_recurrence_on_hosts(spark):
    """No pattern knows this page; its words aren't those of content, and many hosts give it. A real sentence that recurs stays."""
    page, real = "Our gnomes are polishing the whatsit. Kindly knock later.", "The county repeals the bill on raw milk."
    content = [(i, f"https://h{i % 7}.example/{i}", "", f"{REAL} The county clerk repeals item {i} of the raw milk bill at noon, and the committee of the house agreed.") for i in range(60)]
    rows = content + [(100 + i, f"https://h{i}.example/p", "", page.upper() if i % 2 else page) for i in range(4)] + [(200 + i, f"https://h{i}.example/r", "", real) for i in range(4)]
    rows += [(300, "https://h1.example/q", "", "A lone page says: whatsit polishing gnomes.")]
    _, out = residue(spark, rows)
    assert {(r.id, r.kind) for r in out.collect()} == {(100 + i, "notice") for i in range(4)}
