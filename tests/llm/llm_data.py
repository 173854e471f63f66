"""Small documents with what the operators have to survive."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, shard int, kept boolean, fingerprint string, size string, score string"
VOICES = {
    "en": "the of and to in that was he it with as his on be at by had not are but from or have they which one".split(),
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es über größe".split(),
    "fr": "le la les et des en un une du que est pour qui dans par plus pas au sur être été où français".split(),
}
ITEM = "quartz harbour lanterns drift beyond seven copper bridges while patient otters count falling silver rain tonight"


def documents(n: int = 160, seed: int = 5):
    """Small documents with what the operators have to survive; every row has extra columns whose names clash."""
    rng, rows = random.Random(seed), []
    for i in range(n):
        lang = rng.choice(list(VOICES))
        words = [rng.choice(VOICES[lang]) + rng.choice(["", "", "x", "ing", "é", "."]) for _ in range(rng.randint(3, 90))]
        rows.append([i, " ".join(words), lang, f"src{i % 7}" if i % 3 else "src0"])
    rows[41][1] = rows[41][1].replace("é", "e").replace("ü", "u").replace("ö", "o").replace("ß", "s").replace("ê", "e").replace("ù", "u").replace("ç", "c")
    rows[3][1] = rows[40][1] = rows[41][1].upper()
    rows[41][1] = rows[3][1].lower()
    rows[5][1], rows[6][1], rows[7][1], rows[8][1] = None, "", " \n\t ", "1234 5678 !!!"
    rows[9][2], rows[10][3], rows[11][0] = None, None, None
    rows[12][1] = "word " * 30_000
    rows[13][1] = "x" * 50_000
    rows[14][1] = "Released under the MIT License. <|endoftext|> é don't  stop 12 中文 \U0001f600"
    rows[15][1] = f"{rows[15][1]} {ITEM}. {rows[16][1]}"
    rows[17][1] = "before " + ITEM.replace("seven", "nine").replace("otters", "badgers").upper() + " after"
    rows[18][1] = " ".join(ITEM.split()[:5])
    for j in range(60, 110):
        rows[j][1] = "one group of copies that holds a third of all rows"
    rows += [list(rows[20]), list(rows[20]), list(rows[60])]
    return [(*r, len(r[1] or ""), 7, True, "clash", "clash", "clash") for r in rows]
