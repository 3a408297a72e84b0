import public_tokenizers

from cohort_risk.llm import queries, token_counts


def test_table_of_frequent_words_does_not_shrink_with_tasks(docs):
    text = "x " + " ".join(f"word{i}" for i in range(200) for _ in range(2))
    table = docs([(i, text) for i in range(40)]).repartition(20)
    found = token_counts.frequent(table, public_tokenizers.path(queries.BYTE_BPE), table_size=100)
    assert len(found) == 100
