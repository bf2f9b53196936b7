"""Word lists, word pairs and character classes.

These must equal the published values for results to agree; they are data,
kept as plain text in their natural order.
"""

from __future__ import annotations

# --- fixed values: Roman-Urdu word pairs -----------------------------------
ROMAN_URDU = {
    "hai": "is", "hain": "are", "nahi": "not", "ka": "of", "ke": "that", "ko": "to", "ye": "this",
    "woh": "that", "aur": "and", "tum": "you", "hum": "we", "mera": "my", "meri": "my", "kya": "what",
    "kyun": "why", "jab": "when", "liye": "for", "abhi": "now", "bahut": "very", "bohot": "very",
    "acha": "good", "achha": "good", "bura": "bad", "sb": "all", "sabka": "everyone", "sach": "truth",
    "jhoot": "false", "sab": "all",
}

# --- fixed values: English stopwords (179 words) ---------------------------
ENGLISH_STOPWORDS = """
i me my myself we our ours ourselves you you're you've you'll you'd your yours
yourself yourselves he him his himself she she's her hers herself it it's its
itself they them their theirs themselves what which who whom this that that'll
these those am is are was were be been being have has had having do does did
doing a an the and but if or because as until while of at by for with about
against between into through during before after above below to from up down in
out on off over under again further then once here there when where why how all
any both each few more most other some such no nor not only own same so than too
very s t can will just don don't should should've now d ll m o re ve y ain aren
aren't couldn couldn't didn didn't doesn doesn't hadn hadn't hasn hasn't haven
haven't isn isn't ma mightn mightn't mustn mustn't needn needn't shan shan't
shouldn shouldn't wasn wasn't weren weren't won won't wouldn wouldn't
""".split()

# --- fixed values: words kept by, and words added to, the custom list ------
STOPWORDS_KEPT = "not no never nor cannot don doesn didn won wouldn shouldn".split()
STOPWORDS_ADDED = """
also still even many much one two first second new according reported study says
people case cases health vaccine virus covid
""".split()

# --- fixed values: sample terms for the normaliser comparison --------------
DOMAIN_TERMS = """
vaccines vaccination misinformation misinformed reported reports studies study
pandemic pandemics doctors doctor doesn't couldn't allegedly falsehood falsehoods
coronavirus covid symptoms
""".split()

# --- fixed values: word pairs and key terms of the similarity report -------
SIMILARITY_PAIRS = [("covid", "virus"), ("vaccine", "health"), ("fake", "real"),
                    ("reported", "study"), ("pandemic", "lockdown")]
KEY_TERMS = ["covid", "vaccine", "fake", "real", "virus", "health"]

# --- fixed values: code points treated as emoji ----------------------------
EMOJI_RANGES = [
    (0x00A9, 0x00A9), (0x00AE, 0x00AE), (0x200D, 0x200D), (0x203C, 0x203C),
    (0x2049, 0x2049), (0x2122, 0x2122), (0x2139, 0x2139), (0x2194, 0x2199),
    (0x21A9, 0x21AA), (0x231A, 0x231B), (0x23E9, 0x23F3), (0x23F8, 0x23FA),
    (0x2600, 0x27BF), (0x2B00, 0x2BFF), (0xFE0F, 0xFE0F), (0x1F000, 0x1FAFF),
]

# --- fixed values: sentence template of the generated corpus ---------------
TEMPLATE_SUBJECTS = ["Government", "Army", "Supreme Court", "Election Commission",
                     "Prime Minister", "Police"]
TEMPLATE_VERBS = ["secretly approves", "bans", "leaks", "confirms", "plans", "hides"]
TEMPLATE_OBJECTS = ["new law overnight", "hidden agreement with foreign country",
                    "rigged election results", "mass surveillance program",
                    "secret economic deal", "nationwide internet shutdown"]

#: Closed label domain, in sorted order; the second is the positive class.
LABELS = ("fake", "real")


def stopwords(name: str) -> list[str]:
    """Sorted words of the list called ``none``, ``default`` or ``custom``."""
    if name == "none":
        return []
    if name == "default":
        return sorted(ENGLISH_STOPWORDS)
    if name == "custom":
        return sorted((set(ENGLISH_STOPWORDS) - set(STOPWORDS_KEPT)) | set(STOPWORDS_ADDED))
    raise ValueError(f"unknown stopword list: {name}")
