from murmurate.llm.packing import local_search


def test_pairs_of_small_items_are_exchanged():
    sizes = [970, 20, *[40] * 12, 14, 13]
    got = local_search(sizes, [[0, 1], list(range(2, 16))], 1000)
    assert sorted(i for b in got for i in b) == list(range(16))
    assert sorted(sum(sizes[i] for i in b) for b in got) == [500, 997]
