"""Three English stemmers as column expressions, from their published rule tables.

Each takes and adds a column, so a caller stems a table of distinct terms once. Rules are
"suffix replacement" texts; the longest suffix that fits decides, as the papers say.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Test = Callable[[Column], Column]

# After marking, a lower-case y is a vowel and an upper-case Y a consonant.
VOWEL_THEN_CONSONANT = "[aeiouy][^aeiouy]"
CONSONANT_Y = r"^y|(?<=[aeiou])y|(?<=[^aeiouy]y)y"


def measure_over_0(stem: Column) -> Column:
    return stem.rlike(VOWEL_THEN_CONSONANT)


def measure_over_1(stem: Column) -> Column:
    return stem.rlike(f"{VOWEL_THEN_CONSONANT}.*{VOWEL_THEN_CONSONANT}")


def has_vowel(stem: Column) -> Column:
    return stem.rlike("[aeiouy]")


def _pairs(rules: str) -> list[tuple[str, str]]:
    """("suffix", "replacement") of rules such as "sses ss, ies i"; "-" replaces by nothing."""
    pairs = [tuple(r.split()) for r in rules.split(",")]
    return sorted(((s, "" if r == "-" else r) for s, r in pairs), key=lambda p: -len(p[0]))


def _cut(word: Column, suffix: str) -> Column:
    return F.substring(word, F.lit(1), F.length(word) - len(suffix))


def _step(word: Column, rules: str, test: Test, special: dict[str, Test] | None = None) -> Column:
    """Replace the longest fitting suffix when its test holds; otherwise leave the word."""
    out = word
    for suffix, replacement in reversed(_pairs(rules)):
        stem = _cut(word, suffix)
        allowed = (special or {}).get(suffix, test)(stem)
        out = F.when(
            word.endswith(suffix), F.when(allowed, F.concat(stem, F.lit(replacement))).otherwise(word)
        ).otherwise(out)
    return out


# Porter (1980).
PORTER_1A = "sses ss, ies i, ss ss, s -"
PORTER_2 = (
    "ational ate, tional tion, enci ence, anci ance, izer ize, abli able, alli al, entli ent, eli e, "
    "ousli ous, ization ize, ation ate, ator ate, alism al, iveness ive, fulness ful, ousness ous, "
    "aliti al, iviti ive, biliti ble"
)
PORTER_3 = "icate ic, ative -, alize al, iciti ic, ical ic, ful -, ness -"
PORTER_4 = (
    "al -, ance -, ence -, er -, ic -, able -, ible -, ant -, ement -, ment -, ent -, ion -, ou -, "
    "ism -, ate -, iti -, ous -, ive -, ize -"
)


def _ends_cvc(stem: Column) -> Column:
    return stem.rlike("[^aeiouy][aeiouy][^aeiouywxY]$")


def _tidy_1b(stem: Column, short: Column, double: str) -> Column:
    """After -ed or -ing: restore an e, or drop one of two equal consonants."""
    return (
        F.when(stem.rlike("(at|bl|iz)$"), F.concat(stem, F.lit("e")))
        .when(stem.rlike(double), _cut(stem, "x"))
        .when(short, F.concat(stem, F.lit("e")))
        .otherwise(stem)
    )


def porter(df: DataFrame, term: str, out: str) -> DataFrame:
    w = F.col("_w")
    df = df.withColumn("_w", F.regexp_replace(F.lower(term), CONSONANT_Y, "Y"))
    df = df.withColumn("_w", _step(w, PORTER_1A, lambda s: F.lit(True)))

    def dropped(suffix: str) -> Column:
        stem = _cut(w, suffix)
        short = _ends_cvc(stem) & measure_over_0(stem) & ~measure_over_1(stem)
        return F.when(has_vowel(stem), _tidy_1b(stem, short, r"([^aeiouylsz])\1$")).otherwise(w)

    step_1b = (
        F.when(w.endswith("eed"), F.when(measure_over_0(_cut(w, "eed")), _cut(w, "d")).otherwise(w))
        .when(w.endswith("ed"), dropped("ed"))
        .when(w.endswith("ing"), dropped("ing"))
        .otherwise(w)
    )
    df = df.withColumn("_w", step_1b)
    last_y = w.rlike("[yY]$") & has_vowel(_cut(w, "y"))
    df = df.withColumn("_w", F.when(last_y, F.concat(_cut(w, "y"), F.lit("i"))).otherwise(w))
    df = df.withColumn("_w", _step(w, PORTER_2, measure_over_0))
    df = df.withColumn("_w", _step(w, PORTER_3, measure_over_0))
    ion = {"ion": lambda s: measure_over_1(s) & s.rlike("[st]$")}
    df = df.withColumn("_w", _step(w, PORTER_4, measure_over_1, ion))
    stem = _cut(w, "e")
    loses_e = w.endswith("e") & (measure_over_1(stem) | (measure_over_0(stem) & ~_ends_cvc(stem)))
    df = df.withColumn("_w", F.when(loses_e, stem).otherwise(w))
    df = df.withColumn("_w", F.when(w.endswith("ll") & measure_over_1(w), _cut(w, "l")).otherwise(w))
    return df.withColumn(out, F.when(F.length(term) > 2, F.lower(w)).otherwise(F.lower(term))).drop("_w")


# Porter2, the English Snowball stemmer.
SNOWBALL_WORDS = (
    "skis ski, skies sky, dying die, lying lie, tying tie, idly idl, gently gentl, ugly ugli, early earli, "
    "only onli, singly singl, sky sky, news news, howe howe, atlas atlas, cosmos cosmos, bias bias, andes andes"
)
SNOWBALL_STOP_1A = "inning outing canning herring earring proceed exceed succeed".split()
SNOWBALL_2 = (
    "tional tion, enci ence, anci ance, abli able, entli ent, izer ize, ization ize, ational ate, ation ate, "
    "ator ate, alism al, aliti al, alli al, fulness ful, ousli ous, ousness ous, iveness ive, iviti ive, "
    "biliti ble, bli ble, ogi og, fulli ful, lessli less, li -"
)
SNOWBALL_3 = "tional tion, ational ate, alize al, icate ic, iciti ic, ical ic, ful -, ness -, ative -"
SNOWBALL_4 = (
    "al -, ance -, ence -, er -, ic -, able -, ible -, ant -, ement -, ment -, ent -, ism -, ate -, iti -, "
    "ous -, ive -, ize -, ion -"
)


def _short_syllable(stem: Column) -> Column:
    return stem.rlike("[^aeiouy][aeiouy][^aeiouywxY]$") | stem.rlike("^[aeiouy][^aeiouy]$")


def snowball(df: DataFrame, term: str, out: str) -> DataFrame:
    w, r1, r2 = F.col("_w"), F.col("_r1"), F.col("_r2")
    plain = F.regexp_replace(F.lower(term), "^'", "")
    df = df.withColumn("_w", F.regexp_replace(plain, CONSONANT_Y, "Y"))
    region = "^(gener|commun|arsen|.*?[aeiouy][^aeiouy])"
    df = df.withColumn("_r1", F.when(w.rlike(region), F.length(F.regexp_extract(w, region, 1))).otherwise(F.length(w)))
    rest, inner = F.substring(w, r1 + 1, F.length(w)), "^(.*?[aeiouy][^aeiouy])"
    df = df.withColumn("_r2", F.when(rest.rlike(inner), r1 + F.length(F.regexp_extract(rest, inner, 1))).otherwise(F.length(w)))
    in_r1 = lambda stem: F.length(stem) >= r1
    in_r2 = lambda stem: F.length(stem) >= r2

    df = df.withColumn("_w", F.regexp_replace(w, "('s'|'s|')$", ""))
    step_1a = (
        F.when(w.endswith("sses"), _cut(w, "es"))
        .when(w.rlike("^..+ie[ds]$"), _cut(w, "es"))
        .when(w.rlike("ie[ds]$"), _cut(w, "s"))
        .when(w.rlike("(us|ss)$"), w)
        .when(w.rlike("[aeiouy].+s$"), _cut(w, "s"))
        .otherwise(w)
    )
    df = df.withColumn("_w", step_1a)
    df = df.withColumn("_kept", F.when(w.isin(*SNOWBALL_STOP_1A), w))

    def dropped(suffix: str) -> Column:
        stem = _cut(w, suffix)
        short = _short_syllable(stem) & (F.length(stem) <= r1)
        return F.when(has_vowel(stem), _tidy_1b(stem, short, "(bb|dd|ff|gg|mm|nn|pp|rr|tt)$")).otherwise(w)

    step_1b = w
    for suffix in ("ed", "ing", "edly", "ingly"):
        step_1b = F.when(w.endswith(suffix), dropped(suffix)).otherwise(step_1b)
    for suffix in ("eed", "eedly"):
        stem = _cut(w, suffix)
        step_1b = F.when(
            w.endswith(suffix), F.when(in_r1(stem), F.concat(stem, F.lit("ee"))).otherwise(w)
        ).otherwise(step_1b)
    df = df.withColumn("_w", step_1b)
    df = df.withColumn("_w", F.when(w.rlike("^.+[^aeiouy][yY]$"), F.concat(_cut(w, "y"), F.lit("i"))).otherwise(w))
    after = {
        "li": lambda s: in_r1(s) & s.rlike("[cdeghkmnrt]$"),
        "ogi": lambda s: in_r1(s) & s.endswith("l"),
    }
    df = df.withColumn("_w", _step(w, SNOWBALL_2, in_r1, after))
    df = df.withColumn("_w", _step(w, SNOWBALL_3, in_r1, {"ative": in_r2}))
    df = df.withColumn("_w", _step(w, SNOWBALL_4, in_r2, {"ion": lambda s: in_r2(s) & s.rlike("[st]$")}))
    stem = _cut(w, "e")
    step_5 = (
        F.when(w.endswith("e") & (in_r2(stem) | (in_r1(stem) & ~_short_syllable(stem))), stem)
        .when(w.endswith("ll") & in_r2(_cut(w, "l")), _cut(w, "l"))
        .otherwise(w)
    )
    df = df.withColumn("_w", step_5)
    known = F.create_map(*[F.lit(v) for r in SNOWBALL_WORDS.split(", ") for v in r.split()])
    found = F.coalesce(F.element_at(known, F.lower(term)), F.lower(F.coalesce("_kept", "_w")))
    df = df.withColumn(out, F.when(F.length(term) > 2, found).otherwise(F.lower(term)))
    return df.drop("_w", "_r1", "_r2", "_kept")


# Paice and Husk (1990), the Lancaster stemmer. A rule is the ending spelled
# backwards, * for words not yet changed, the number of letters removed, letters added, and
# > to go on or . to stop.
LANCASTER = """
ai*2. a*1. bb1. city3s. ci2> cn1t> dd1. dei3y> deec2ss. dee1. de2> dooh4> e1> feil1v. fi2> gni3>
gai3y. ga2> gg1. ht*2. hsiug5ct. hsi3> i*1. i1y> ji1d. juf1s. ju1d. jo1d. jeh1r. jrev1t. jsim2t.
jn1d. j1s. lbaifi6. lbai4y. lba3> lbi3. lib2l> lc1. lufi4y. luf3> lu2. lai3> lau3> la2> ll1. mui3.
mu*2. msi3> mm1. nois4j> noix4ct. noi3> nai3> na2> nee0. ne2> nn1. pihs4> pp1. re2> rae0. ra2. ro2>
ru2> rr1. rt1> rei3y> sei3y> sis2. si2> ssen4> ss0. suo3> su*2. s*1> s0. tacilp4y. ta2> tnem4> tne3>
tna3> tpir2b. tpro2b. tcud1. tpmus2. tpec2iv. tulo2v. tsis0. tsi3> tt1. uqi3. ugo1. vis3j> vie0.
vi2> ylb1> yli3y> ylp0. yl2> ygo1. yhp1. ymo1. ypo1. yti3> yte3> ytl2. yrtsi5. yra3> yro3> yfi3.
ycn2t> yca3> zi2> zy1s.
""".split()


def _lancaster_rule(rule: str) -> tuple[str, bool, int, str, bool]:
    place = next(i for i, c in enumerate(rule) if c.isdigit())
    ending = rule[:place]
    return ending.rstrip("*")[::-1], ending.endswith("*"), int(rule[place]), rule[place + 1 : -1], rule[-1] == ">"


def lancaster(df: DataFrame, term: str, out: str) -> DataFrame:
    """Rules apply again and again, at most once per letter of the word."""

    by_letter: dict[str, list[str]] = {}
    for ending, fresh_only, removed, added, again in map(_lancaster_rule, LANCASTER):
        left = f"length(s.word) - {removed}"
        fits = (
            f"endswith(s.word, '{ending}') AND ((s.word RLIKE '^[aeiouy]' AND {left} >= 2)"
            f" OR (s.word RLIKE '^[^aeiouy](.?)[aeiouy]' AND {left} >= 3))" + (" AND s.fresh" if fresh_only else "")
        )
        changed = f"concat(substring(s.word, 1, {left}), '{added}')"
        new = f"named_struct('word', {changed}, 'fresh', false, 'go', {str(again).lower()})"
        by_letter.setdefault(ending[-1], []).append(f"WHEN {fits} THEN {new}")
    done = "named_struct('word', s.word, 'fresh', false, 'go', false)"
    letters = " ".join(
        f"WHEN '{letter}' THEN CASE {' '.join(rules)} ELSE {done} END" for letter, rules in by_letter.items()
    )
    once = f"(s, i) -> CASE WHEN s.go THEN CASE right(s.word, 1) {letters} ELSE {done} END ELSE s END"
    start = f"named_struct('word', lower({term}), 'fresh', true, 'go', true)"
    turns = f"sequence(1, greatest(length({term}), 1))"
    return df.withColumn(out, F.expr(f"aggregate({turns}, {start}, {once}, s -> s.word)"))
