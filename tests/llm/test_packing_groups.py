import corpus_pipeline
import pytest

from shipyard.llm import queries
from tests.llm.cases import documents


@pytest.mark.parametrize("module", [queries, corpus_pipeline])
def test_groups_follow_the_pieces(spark, tmp_path, monkeypatch, module):
    """Few long documents are many pieces: these set the number of groups."""
    docs = documents(spark, [(i, " ".join(f"w{i}x{k}" for k in range(4000)), "en", "s") for i in range(3)])
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    asked, pack = [], module.pack

    def seen(pieces, expected_rows, **more):
        asked.append(expected_rows)
        return pack(pieces, expected_rows=expected_rows, **more)

    monkeypatch.setattr(module, "pack", seen)
    packed = module.op1_best_fit_packing(spark, str(tmp_path)) if module is queries else module.packing(spark, docs, "")
    assert asked == [packed.count()] and asked[0] > 20
