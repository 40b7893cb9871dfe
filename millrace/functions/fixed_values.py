"""Fixed values.  Patterns, word lists, templates and limits that decide results.

Everything in this file is a constant that has to keep exactly this value for a
corpus to come out the same; the code that uses it lives elsewhere.

Patterns are written for java.util.regex with explicit Unicode classes (``S``
whitespace, ``D`` digit, ``W`` word character), so they mean the same on every
JVM.  The classes test the plain range before any Unicode property, which is
what most characters need.
"""

# -- fixed values: character classes -----------------------------------------
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004"
    "\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
S_SET = r"\t-\r\x{1c}-\x{20}\x{85}\x{a0}[\x{1680}-\x{3000}&&[\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]]"
W_SET = r"a-zA-Z0-9_[\x{80}-\x{10ffff}&&[\p{L}\p{N}]]"
S = f"[{S_SET}]"
W = f"[{W_SET}]"
D = r"\p{Nd}"
NOT_AFTER_WORD = f"(?<!{W})"
NOT_BEFORE_WORD = f"(?!{W})"

# -- fixed values: text patterns ----------------------------------------------
NUMBER = rf"{D}+([.,]{D}+)?"
NUMBER_MARK = "<num>"
CANONICAL_EDGE = " ?."
LETTER_PREFIX = rf"^(?:\([A-E]\)\*?|[A-E]\))+{S}*"
CORRECT_WORD = "correct"  # part of every match of the first statement
ANSWER_WORD = "answer"  # part of every match of all statements
ANSWER_STATEMENTS = (  # the answer letter follows each of these
    rf"[\-=~>]*{S}*the{S}+correct{S}+answer{S}+is{S}+",
    rf"(?=[ac])(answer|correct answer){S}*:{S}*",
    rf"the answer is{S}*:{S}*",
)
ANS_LETTER = (rf"Ans{S}+", rf"\.?{S}*(?:\r?\n)?")  # before and after the letter
SOLUTION_PREFIX = rf"^(solution|sol\.?|explanation|expl)"
SOLUTION_PREFIX_TAIL = rf"{S}*:?{S}*\.?{S}*"
EXPLANATION_PREFIX = rf"^(exp(l(anation)?)?\.?){S}*:{S}*"
LEADING_ANSWER = (
    rf"^ans(?:wer)?\.?{S}*(is)?{S}*[:=]?{S}*[\(\[\']?[a-dA-D]",
    rf"[\)\]\']?(?:\.|:)?(?:{S}*i\.?e\.?|,)?{S}*",
)
LEADING_PUNCTUATION = rf"^[.,;:\-{S_SET}]+"
# every whitespace run but a single space; the look-ahead rules out most characters at once
SPACE_RUN = rf"(?=[\x{{0}}-\x{{20}}\x{{80}}-\x{{3000}}])(?:[{S}&&[^ ]]{S}*+| {S}++)"
URL = f"https?://[^{S_SET}]"
URL_LOOSE = rf"(?=[hw])(https?{S}*:{S}*//|www{S}*\.)"
FIGURE_WORD = "figure"  # part of every match of FIGURE
FIGURE = rf"{NOT_AFTER_WORD}(see|as{S}+shown{S}+in|refer{S}+to){S}+Figure{NOT_BEFORE_WORD}"
TEXTBOOKS = (
    "harrison", "guyton", "robbins", "chandrasoma", "kdt", "bdc", "snell", "goodman",
    "gilman", "harper", "uptodate", "lippincott", "ganong", "grays", "netter",
)
CITATION_LINK = "http[s]?://"
CITATIONS = (  # each begins where a word begins
    rf"ref(?:er)?{NOT_BEFORE_WORD}",
    rf"chapter{NOT_BEFORE_WORD}{S}*{D}+",
    rf"p(?:ages?|g)?\.?{S}*{D}+",
    rf"volume{NOT_BEFORE_WORD}{S}*{D}+",
    rf"(?:[1-9][0-9]?)(?:/?e|th edition){NOT_BEFORE_WORD}",
    r"www\.",
    rf"({'|'.join(TEXTBOOKS)}){NOT_BEFORE_WORD}",
)
# what a citation can begin with: the textbooks' first letters and those of the patterns above
CITATION_START = f"[{''.join(sorted({name[0] for name in TEXTBOOKS} | set('rcpvw')))}1-9]"
SYMBOL = f"[^{W_SET}{S_SET}]"
TOKEN = f"{W}+|{SYMBOL}"
TOKEN_AND_SPACE = f"(?:{W}++|{SYMBOL}){S}*+"

# letters and numbers of Unicode 14 to 15.1: words to Python 3.13, symbols to Java 17, and so here
LATER_WORD = (
    r"\u0870-\u0887\u0889-\u088e\u08b5\u08c8-\u08c9\u0c5d\u0cdd\u170d\u171f\u1b4c\u2c2f\u2c5f"
    r"\u9ffd-\u9fff\ua7c0-\ua7c1\ua7d0-\ua7d1\ua7d3\ua7d5-\ua7d9\ua7f2-\ua7f4\U00010570-\U0001057a"
    r"\U0001057c-\U0001058a\U0001058c-\U00010592\U00010594-\U00010595\U00010597-\U000105a1"
    r"\U000105a3-\U000105b1\U000105b3-\U000105b9\U000105bb-\U000105bc\U00010780-\U00010785"
    r"\U00010787-\U000107b0\U000107b2-\U000107ba\U00010f70-\U00010f81\U00011071-\U00011072\U00011075"
    r"\U0001123f-\U00011240\U00011740-\U00011746\U00011ab0-\U00011abf\U00011f02\U00011f04-\U00011f10"
    r"\U00011f12-\U00011f33\U00011f50-\U00011f59\U00012f90-\U00012ff0\U0001342f\U00013441-\U00013446"
    r"\U00016a70-\U00016abe\U00016ac0-\U00016ac9\U0001aff0-\U0001aff3\U0001aff5-\U0001affb"
    r"\U0001affd-\U0001affe\U0001b11f-\U0001b122\U0001b132\U0001b155\U0001d2c0-\U0001d2d3"
    r"\U0001df00-\U0001df1e\U0001df25-\U0001df2a\U0001e030-\U0001e06d\U0001e290-\U0001e2ad"
    r"\U0001e4d0-\U0001e4eb\U0001e4f0-\U0001e4f9\U0001e7e0-\U0001e7e6\U0001e7e8-\U0001e7eb"
    r"\U0001e7ed-\U0001e7ee\U0001e7f0-\U0001e7fe\U0002a6de-\U0002a6df\U0002b735-\U0002b739"
    r"\U0002ebf0-\U0002ee5d\U00031350-\U000323af"
)

# -- fixed values: characters accepted besides ASCII, maths symbols, lower-case letters
EXTRA_ALLOWED = "⁄×⇒→…‘’“”−∴∵πθαβΔ‹›€"
# characters whose Unicode name contains GREEK although their script is not Greek
GREEK_NAMED = (
    r"\x{342}-\x{345}\x{374}\x{37e}\x{385}\x{387}\x{2129}\x{2719}\x{271a}"
    r"\x{1f7a1}-\x{1f7a7}\x{1fbbb}"
)
# characters of Greek script whose Unicode name does not contain GREEK
GREEK_UNNAMED = r"\x{1d5d}\x{1d5f}\x{1d61}\x{1dbf}\x{2126}\x{1018e}"

# -- fixed values: templates --------------------------------------------------
QUIZ_PREAMBLE = (
    "The following are multiple-choice questions (with answers) about advanced STEM knowledge.\n\n"
)
RELATED_ANSWER = "Example of related question Q and answer A: Q: "
RELATED_HINT = "Example of related question Q and hint H: Q: "
RELATED_HINT_UNSPACED = "Example of related question Q and hint H: Q:"
VERIFY_HEAD = "\nYou are given two versions of a problem explanation.\n\nOriginal:\n"
VERIFY_MIDDLE = "\n\nCleaned:\n"
VERIFY_TAIL = (
    "\n\nTask:\n"
    "Determine if the cleaned version preserves all the logical and mathematical reasoning "
    "from the original version. \n"
    "Ignore formatting changes like whitespace, symbols like '--->', 'Ans', or line breaks.\n"
    "Focus only on whether any meaningful steps, values, or inferences were removed or altered.\n\n"
    "Respond with one of:\n"
    '- "MATCH: Cleaned version faithfully preserves the original reasoning."\n'
    '- "MISMATCH: Cleaned version removes or changes important reasoning."\n\n'
    "If there’s a mismatch, explain briefly what was lost or changed.\n"
)
FIELD_MARK = "¶"

# -- fixed values: sources, weights, limits -----------------------------------
SCIQ = "allenai/sciq"
PUBMED = "qiaojin/PubMedQA"
ARC_EASY = "allenai/ai2_arc (ARC-Easy)"
ARC_CHALLENGE = "allenai/ai2_arc (ARC-Challenge)"
AQUA = "deepmind/aqua_rat"
EVAL_SET = "TIGER-Lab/MMLU-Pro"
MIX_SHARES = {
    "sciq": 0.20, "aqua_rat": 0.25, "medmcqa": 0.25, "ai2_arc_challenge": 0.15, "openbookqa": 0.15,
}
SUBJECT_WEIGHTS = {
    "Anatomy": 0.10, "Physiology": 0.10, "Biochemistry": 0.10, "Pathology": 0.10,
    "Microbiology": 0.10, "Pharmacology": 0.10, "Medicine": 0.07, "Surgery": 0.04,
    "Pediatrics": 0.04, "Gynaecology & Obstetrics": 0.03, "Psychiatry": 0.03, "Skin": 0.03,
    "Ophthalmology": 0.02, "Orthopaedics": 0.02, "Anaesthesia": 0.02, "Radiology": 0.02,
    "ENT": 0.01, "Social & Preventive Medicine": 0.05,
}
MCQ_FIELDS = ("question_id", "question", "choices", "answer", "rationale", "dataset")
SEED = 42
MASK = -100
SHORT_RATIONALE = 27
MIN_SHORT_RATIONALE = 8
MIN_ANSWER_CHARS = 10
PASSAGE_TOKENS = 512
MAX_PASSAGES = 100_000
HASHED_TOKENS = 400_000  # kept by a task with their ids
HASHED_BYTES = 8_000_000  # of texts cut into tokens at once
QUIZ_TOKENS = 384
PADDED_TOKENS = 512
PREFERENCE_PROMPT_TOKENS = 400
PREFERENCE_TOTAL_TOKENS = 800
CLUSTERS = 20_000
CLUSTER_ITERATIONS = 25
HOLDOUT_ROWS = 4_000
SCIQ_TOPUP_ROWS = 150
AQUA_TOPUP_SHARE = 0.08
MATH_ROWS = 200_000
CODE_ROWS = 80_000
ENCODE_BATCH = 256
WRITE_BATCH = 25
SHARD_BYTES = 500 * 10**6  # of a written file
