import random

from pyspark.sql import functions as F

from newsloom.functions import bylines as B

CASES = {
    "By David Ornstein June 19, 2026 3:19 am 리버풀이 협상 중이다.": ["David Ornstein"],
    "By James McNicholas and Art de Roché July 3, 2026 Updated 2:46 am 아스날이": ["James McNicholas", "Art de Roché"],
    "훌리안 알바레스(왼쪽)와 크루피 By Art de Roché July 17, 2026 1:16 pm 작년": ["Art de Roché"],
    "By SIMON JONES\n\nPublished: 17:30 GMT, 20 July 2026 아스날이": ["SIMON JONES"],
    "아스날이 비니시우스 주니오르 영입을 추진한다.": [],
    "By Will Magee, Niall McVeigh and Billy Munday 아스날이": ["Will Magee", "Niall McVeigh", "Billy Munday"],
    "By KIERAN GILL, MAIL SPORT REPORTER 아스날이": ["KIERAN GILL"],
    "By David Ornstein Aug. 2, 2026 아스날이": ["David Ornstein"],
    "By Mario Cortegana Aug 3, 2026 아스날이": ["Mario Cortegana"],
    "Told By May 3, 2024 and By Ann  Lee, and Bo": ["Ann  Lee"],
    "By Updated 2:46 am": [],
    "Goodby Ann. Standby Ann": [],
    "By Ann Lee,Bo Ray": ["Ann Lee"],
    "By Ann Lee, Ann Lee and de Bo": ["Ann Lee"],
    "x" * 190 + " By Ann Lee Cutoff": ["Ann Le"],
    "By 데이비드 온스테인 얀 디오망데는 이번 여름 RB 라이프치히를 떠나게 된다면": ["데이비드 온스테인"],
    "By 제임스 맥니콜라스, 데이비드 온스테인, 크리스 워 아스날은 협상을 한다": ["제임스 맥니콜라스", "데이비드 온스테인", "크리스 워"],
    "데이비드 온스테인 기자가 전한 소식이다.": [],
    "글: 로리 휘트웰, 베렌 크로스": ["로리 휘트웰", "베렌 크로스"],
    "이 글 아스날 팬이라면 꼭 보세요": [],
    "(데이비드 온스테인, 제이콥 탠스웰) 알 힐랄이 제안했다.": ["데이비드 온스테인", "제이콥 탠스웰"],
    "(이 기사는 원래 6월 26일에 게재됐으며, 기마랑이스가 의사를 밝혔다) 글": [],
    "플로리안 플라텐버그: 바이어 레버쿠젠은 관심을 받고 있는": ["플로리안 플라텐버그"],
    "The Athletic-데이비드 온스테인 맨체스터 유나이티드는": ["데이비드 온스테인"],
    "이번 이적시장 정리: 아스날은 미드필더를 원한다": [],
    "아스날 (4-2-3-1): 라야 7; 화이트 7, 모스케라 7": [],
    "Alex Howell Arsenal reporter With a squad that won": ["Alex Howell"],
    "Sami Mokbel Senior football correspondent Arsenal have agreed": ["Sami Mokbel"],
    "Mikel Arteta told reporters that Arsenal are ready": [],
    "Arsenal have agreed a fee. Sami Mokbel Senior football correspondent": [],
    "": [],
    None: [],
}


def columns(spark, texts, *cols):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", *[c(F.col("t")).alias(f"c{k}") for k, c in enumerate(cols)]).collect()
    return [tuple(r)[1:] for r in sorted(rows)]


def test_authors(spark):
    got = columns(spark, list(CASES), B.body_authors)
    assert {t: g[0] for t, g in zip(CASES, got, strict=True)} == CASES


def slow(text):
    """Marked names by hand, a character at a time; None without a byline."""
    text, particles = text[:200], B.PARTICLES.split("|")

    def dated(i):
        for m in B.MONTHS.split("|"):
            if text.startswith(m, i):
                j = i + len(m)
                j += text[j : j + 1] == "."
                k = j
                while k < len(text) and text[k].isspace():
                    k += 1
                if k > j and text[k : k + 1].isdigit():
                    return True
        return text.startswith("Updated", i) and not (text[i + 7 : i + 8].isalnum() or text[i + 7 : i + 8] == "_")

    def word(i):
        if not ("A" <= text[i : i + 1] <= "Z") or dated(i):
            return i
        i += 1
        while i < len(text) and (text[i].isalnum() or text[i] in "_'’-"):
            i += 1
        return i

    def blanks(i):
        while text[i : i + 1] == " ":
            i += 1
        return i

    for start in range(len(text)):
        if not text.startswith("By ", start) or (start and (text[start - 1].isalnum() or text[start - 1] == "_")):
            continue
        begin = at = blanks(start + 2)
        names = []
        if word(at) == at:
            continue
        while True:
            at = word(at)
            while (gap := blanks(at)) > at:
                nxt = gap
                for p in particles:
                    if text.startswith(p + " ", gap):
                        nxt = blanks(gap + len(p))
                if word(nxt) == nxt:
                    nxt = gap
                if word(nxt) == nxt:
                    break
                at = word(nxt)
            names.append(text[begin:at])
            sep = blanks(at)
            size = 1 if text[sep : sep + 1] == "," else 3 if text.startswith("and", sep) and sep > at else 0
            begin = blanks(sep + size)
            if not size or begin == sep + size or word(begin) == begin:
                break
            at = begin
        return list(dict.fromkeys(n for n in names if not any(j in n.upper() for j in B.JOBS.split("|"))))
    return None


def test_marked_names_equal_a_slow_reading(spark):
    rng = random.Random(7)
    bits = ["By ", "By  ", " ", "  ", ", ", ",", " and ", "and ", " de ", "van ", "Ann", "O'Neil", "Lee-Ray", "Émile", "Mario", "May", "May 3", "Aug. 12", "Updated", "Updates", "Sports Writer", "x", "\n", ".", "김", "2024"]
    texts = [rng.choice(["", "By Ann", "x By Lee-Ray van Émile"]) + "".join(rng.choice(bits) for _ in range(rng.randint(1, 18))) for _ in range(1500)]
    got = columns(spark, texts, lambda t: B.marked_authors(F.substr(t, F.lit(1), F.lit(200))))
    for text, (names,) in zip(texts, got, strict=True):
        assert names == slow(text), text
    assert sum(bool(n) and len(n) > 1 for (n,) in got) > 25 and sum(bool(n) for (n,) in got) > 500


def test_publish_time_is_cut_from_the_head(spark):
    lead = "아스날의 2014년 여름을 돌아본다. " * 12
    cases = {
        "By David Ornstein June 19, 2026 3:19 am 리버풀이": "By David Ornstein 리버풀이",
        "By Art de Roché July 3, 2026 Updated 2:46 am 아스날이": "By Art de Roché 아스날이",
        lead + "— (@ChampionsLeague) March 4, 2019 벵거": lead + "— (@ChampionsLeague) March 4, 2019 벵거",
        "지난 6월 24일, 2030년까지": "지난 6월 24일, 2030년까지",
        "March 4, 2019": "March 4, 2019",
        "": "",
        None: None,
    }
    assert [g[0] for g in columns(spark, list(cases), B.without_publish_time)] == list(cases.values())


def test_a_mark_that_is_followed_by_itself_marks_nobody(spark):
    cases = {"By By By By": [], "Alex Howell Arsenal reporter With a squad, By By By": ["Alex Howell"], "By By, Ann Lee": ["Ann Lee"], "By By Ann": ["By Ann"], "By SPORT REPORTER": [], "By By Byron": ["By Byron"]}
    assert {t: g[0] for t, g in zip(cases, columns(spark, list(cases), B.body_authors), strict=True)} == cases
