from millrace.functions import text as X
from millrace.functions import tokens as T


def test_trim_ws_strips_every_unicode_space(one):
    assert one(X.trim_ws, ["　 a b \x1c\n", "", " \t"]) == ["a b", "", ""]


def test_blank_counts_null_and_spaces(one):
    assert one(X.is_blank, [None, "", "  \n", " x "]) == [True, True, True, False]


def test_canonicalize(one):
    assert one(X.canonicalize, ["  What is 3.5 +\n 1,000? ", "A  .?", "٣ and Ⅻ", "1.2.3"]) == [
        "what is <num> + <num>", "a", "<num> and ⅻ", "<num>.<num>",
    ]


def test_normalize_spaces_collapses_all_runs(one):
    assert one(X.normalize_spaces, [" a  b\tc \n\n d  e ", "a b", "x y", "\t \t"]) == [
        "a b c d e", "a b", "x y", "",
    ]


def test_append_answer_drops_last_line(one):
    assert one(X.append_answer, [" a \n b \nAnswer B", " single ", "\nlast", "a\n"], list("BCDA")) == [
        "a \n b\nThe answer is: B", " single \nThe answer is: C", "\nThe answer is: D", "a\nThe answer is: A",
    ]


def test_strip_answer_statements_is_literal(one):
    texts = [
        "x ---> the  Correct answer is B.", "The answer is: B", "correct answer : b and", "answer: all",
        "the answer is : B", "nothing here", "==~> THE CORRECT ANSWER IS b",
    ]
    assert one(X.strip_answer_statements, texts, ["B", "B", "B", "A", "B", "B", "B"]) == [
        "x .", "", "and", "ll", "", "nothing here", "",
    ]


def test_strip_answer_label_is_quoted(one):
    assert one(X.strip_answer_statements, ["answer: a+b", "answer: aab"], ["a+b", "a+b"]) == ["", "answer: aab"]


def test_strip_ans_letter_is_case_sensitive(one):
    assert one(X.strip_ans_letter, ["so Ans D.\nnext", "ans D", "Ans  D. \r\n x"], ["D", "D", "D"]) == [
        "so next", "ans D", "x",
    ]


def test_solution_prefix_without_and_with_word_boundary(one):
    texts = ["Solution: x", "Sol. y", "Solving z", "EXPLANATION . w", "expl v", "the solution"]
    assert one(X.strip_solution_prefix, texts) == ["x", "y", "ving z", "w", "v", "the solution"]
    assert one(lambda t: X.strip_solution_prefix(t, word_boundary=True), texts)[2] == "Solving z"


def test_explanation_prefix(one):
    assert one(X.strip_explanation_prefix, ["Exp: a", "expl. : b", "Explanation:c", "exp d"]) == ["a", "b", "c", "exp d"]


def test_dashes_and_quotes(one):
    assert one(X.normalize_dashes, ["a–b—c-d"]) == ["a-b-c-d"]
    assert one(X.soften_quotes, ['say "x"\ny']) == ["say 'x'\ny"]
    assert one(lambda t: X.soften_quotes(t, newlines=True), ['say "x"\ny']) == ["say 'x' y"]


def test_remove_answer_mention(one):
    texts = ["Ans. (A) i.e., heart", "Answer is B: because", "ans=c - lungs", "Ansa", "Anatomy first", ". ; - x"]
    assert one(X.remove_answer_mention, texts) == ["heart", "because", "lungs", "", "Anatomy first", "x"]
    assert one(lambda t: X.remove_answer_mention(t, word_boundary=True), ["Ansatz"]) == ["Ansatz"]


def test_last_question(one):
    texts = [
        "Question: 1?\nAnswer: 1\n\nQuestion: 2 ?\nAnswer:", "a\n\n b ", "Answer: x Question: y",
        "Question: open", None, "", "Question: q Answer: a Question: r",
    ]
    assert one(X.last_question, texts) == ["2 ?", "b", "", "open", None, "", "q"]


def test_after_last(one):
    assert one(lambda t: X.after_last(t, "A: "), ["A: x A: y", "none"]) == ["y", "none"]


def test_token_counts_agree_with_token_lists(one):
    from pyspark.sql import functions as F

    texts = ["a b, c!", "", "  lead and trail \n", "été—ça_va 12.5", "　", "x", None]
    assert one(T.count_tokens, texts) == [5, 0, 3, 6, 0, 1, None]
    assert one(lambda t: F.size(T.split_tokens(t)), texts[:6]) == [5, 0, 3, 6, 0, 1]
