"""Input schemas.  Readers never infer a schema."""

SCIQ_RAW = (
    "question string, distractor1 string, distractor2 string, distractor3 string, "
    "correct_answer string, support string"
)
AQUA_RAW = "question string, options array<string>, rationale string, correct string"
MATHQA_RAW = "Problem string"
LABELLED_CHOICES = "choices struct<text: array<string>, label: array<string>>, answerKey string"
ARC_RAW = f"id string, question string, {LABELLED_CHOICES}"
OPENBOOK_RAW = f"question_stem string, {LABELLED_CHOICES}"
MEDMCQA_RAW = (
    "question string, opa string, opb string, opc string, opd string, cop string, "
    "choice_type string, exp string, subject_name string"
)
PUBMEDQA_RAW = (
    "pubid bigint, question string, context struct<contexts: array<string>>, "
    "long_answer string, final_decision string"
)
MMLU_PRO_RAW = "question string, options array<string>, answer string"
MCQA = (
    "question_id string, question string, choices array<string>, answer string, "
    "rationale string, dataset string"
)
VERDICTS = "question_id bigint, original string, cleaned string, verdict string, chat_id string"
SELECTED = "question string, answer string"
PASSAGES = "text string, source string"
PAIRS = "question string, context string, source string"
PREFERENCES = "prompt string, chosen string, rejected string, dataset string, id string"
