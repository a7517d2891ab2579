from collections import Counter
from pathlib import Path


def test_base_names_are_unique():
    """Two test files of one name hide each other from the collection."""
    names = Counter(p.name for p in Path(__file__).parent.rglob("test_*.py"))
    assert not [n for n, times in names.items() if times > 1]
