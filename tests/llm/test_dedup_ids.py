from gleanery.llm import bottomk

A = " ".join(f"a{i}" for i in range(60))
B = " ".join(f"b{i}" for i in range(60))
NEAR_A, NEAR_B = A + " a", B + " b"


def left(docs):
    return sorted((r.doc_id, r.text) for r in bottomk.drop_near_duplicates(docs).collect())


def test_unequal_texts_of_one_id_are_documents_of_their_own(make):
    assert left(make([(5, A), (5, B)])) == [(5, A), (5, B)]
    for x, near, y in ((A, NEAR_A, B), (B, NEAR_B, A)):
        assert left(make([(3, near), (5, x), (5, y)])) == [(3, near), (5, y)]
    one = left(make([(5, A), (5, NEAR_A), (5, A)]))
    assert one in ([(5, A)], [(5, NEAR_A)])
    assert left(make([(5, ""), (5, A), (5, A.upper())])) in ([(5, ""), (5, A)], [(5, ""), (5, A.upper())])


def test_links_of_each_text_of_one_id(make):
    rows = [(5, A), (5, B), (9, NEAR_B), (8, NEAR_A), (7, "other text here")]
    got = {r.doc_id: r.component_id for r in bottomk.near_duplicates(make(rows)).collect()}
    assert got == {5: 5, 9: 5, 8: 5, 7: 7}
    got = bottomk.near_duplicates(make([(3, NEAR_A), (5, A), (5, B), (9, NEAR_B)])).collect()
    assert sorted((r.doc_id, r.component_id) for r in got) == [(3, 3), (5, 3), (5, 5), (9, 5)]
