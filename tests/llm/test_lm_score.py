import numpy as np
import pyarrow as pa
import pytest

from rollcall.llm import lm_score as m
from tests.llm.helpers import clashing, documents, odd_documents


def small_weights(seed=0):
    rng = np.random.default_rng(seed)
    return {n: rng.normal(0, 0.3, s) for n, s in m.SHAPES.items()}


def sample(n=40, seed=1):
    rng = np.random.default_rng(seed)
    return rng.integers(0, m.CLASSES + 1, (n, 2 * m.WINDOW)), rng.integers(0, m.CLASSES, n)


def loss(weights, around, wanted):
    return -m.class_log_probabilities(weights, around, wanted).mean()


def test_probabilities_add_up_and_follow_the_formula():
    weights = small_weights()
    around, _ = sample(5)
    for row in around:
        logs = [m.class_log_probabilities(weights, row[None], np.array([c]))[0] for c in range(m.CLASSES)]
        assert np.exp(logs).sum() == pytest.approx(1)
        hidden = np.tanh(sum(weights["embed"][c] @ weights["mix"][i] for i, c in enumerate(row)) + weights["bias"])
        plain = hidden @ weights["out"] + weights["prior"]
        assert np.allclose(logs, plain - np.log(np.exp(plain).sum()))


@pytest.mark.parametrize("name", list(m.SHAPES))
def test_gradients_by_differences(name):
    trainer = m.Trainer(small_weights(3))
    around, wanted = sample()
    gradient = trainer.gradients(around, wanted)[name]
    rng = np.random.default_rng(4)
    for _ in range(8):
        at = tuple(rng.integers(0, s) for s in gradient.shape)
        step = 1e-5
        trainer.weights[name][at] += step
        up = loss(trainer.weights, around, wanted)
        trainer.weights[name][at] -= 2 * step
        down = loss(trainer.weights, around, wanted)
        trainer.weights[name][at] += step
        assert gradient[at] == pytest.approx((up - down) / (2 * step), abs=1e-6)


def test_weights_survive_flattening():
    weights = m.first_weights(np.ones(m.CLASSES))
    assert all((m.shaped(m.flat(weights))[n] == weights[n]).all() for n in m.SHAPES)


def test_positions_do_not_cross_documents():
    around, wanted = m._positions([np.array([1, 2]), np.array([], dtype=np.int64), np.array([3])])
    edge = m.CLASSES
    assert wanted.tolist() == [1, 2, 3]
    assert around.tolist() == [[edge] * 3 + [2, edge, edge], [edge, edge, 1] + [edge] * 3, [edge] * 6]


def test_scores_equal_a_word_by_word_sum(spark):
    texts = ["the cat sat on the mat", "the dog sat", "a cat and a dog", "unseen", "The the THE"] * 3
    docs = documents(spark, texts)
    words = m.vocabulary(docs)
    weights = m.train(docs, words)
    rows = {r["doc_id"]: r for r in m.pseudo_likelihood(docs).collect()}
    for doc_id, text in enumerate(texts):
        numbers = words.read(text).tolist()
        classes = [words.classes[n] for n in numbers]
        total = 0.0
        for i, number in enumerate(numbers):
            near = [classes[i + s] if 0 <= i + s < len(classes) else m.CLASSES for s in (-3, -2, -1, 1, 2, 3)]
            total += m.class_log_probabilities(weights, np.array([near]), np.array([classes[i]]))[0] + words.shares[number]
        assert rows[doc_id]["log_probability"] == pytest.approx(total, rel=1e-5)
        assert rows[doc_id]["n_words"] == len(numbers)
        assert rows[doc_id]["per_word"] == pytest.approx(total / len(numbers), rel=1e-5)


def test_vocabulary_counts_everything(spark, monkeypatch):
    monkeypatch.setattr(m, "VOCABULARY", 3)
    docs = documents(spark, ["a a a b b c", "a B d", None, ""])  # 3 of 9 words and more
    words = m.vocabulary(docs)
    assert set(words.known) == {"a", "b"}
    assert words.shares[0] == pytest.approx(-np.log(2))  # c and d
    for c in set(words.classes[1:].tolist()):
        own = [np.exp(s) for s, k in zip(words.shares[1:], words.classes[1:]) if k == c]
        assert sum(own) == pytest.approx(1)


def test_order_is_likelier_than_disorder(spark):
    rng = np.random.default_rng(8)
    texts = []
    for _ in range(300):
        texts.append(" ".join(f"{'xyz'[i % 3]}{rng.integers(0, 5)}" for i in range(60)))
    docs = documents(spark, [*texts, " ".join(rng.permutation(texts[0].split()))])
    rows = {r["doc_id"]: r["per_word"] for r in m.pseudo_likelihood(docs).collect()}
    assert rows[300] < np.mean([rows[i] for i in range(300)]) - 0.1


def test_odd_rows(spark):
    odd = clashing(odd_documents(spark), "place", "value", "word", "n")
    rows = m.pseudo_likelihood(odd).collect()
    assert len(rows) == odd.count()
    assert {r["doc_id"]: r["per_word"] for r in rows}[2] is None
    assert all(r["log_probability"] == 0 for r in rows if not r["n_words"])
    assert m.pseudo_likelihood(odd.limit(0)).count() == 0
    assert m.pseudo_likelihood(documents(spark, [None, ""])).count() == 2


def test_rare_words_have_the_share_of_their_count(spark):
    common = " ".join(["a"] * 70_000)
    docs = documents(spark, [common, "b b\u00a0B c", "\u0130x c", "b", "c", None])
    counts = m.word_counts(docs)
    words = m.vocabulary(docs, counts)
    words.known, words.sums = {"a": 1}, words.sums.copy()
    words.sums[m.UNKNOWN] = 8
    score = m._score(words, m.first_weights(words.sums))
    found = docs.select("doc_id", "text").mapInArrow(score, f"doc_id long, n_words long, known double, {m.RARE}")
    shares = {r["row"]: r["others"] for r in m.rare_shares(found.withColumnRenamed("doc_id", "row"), counts, words).collect()}
    b, c, x = np.log(4 / 8), np.log(3 / 8), np.log(1 / 8)
    assert shares == {1: pytest.approx(3 * b + c), 2: pytest.approx(x + c), 3: pytest.approx(b), 4: pytest.approx(c)}


def test_counts_of_rare_words_change_the_score(spark, monkeypatch):
    monkeypatch.setattr(m, "VOCABULARY", 3)  # on the driver, which chooses the vocabulary
    docs = documents(spark, ["a a a a a a a a", "often", "often", "often", "seldom"])
    rows = {r["doc_id"]: r["log_probability"] for r in m.pseudo_likelihood(docs).collect()}
    assert rows[1] - rows[4] == pytest.approx(np.log(3), abs=1e-6)


def test_every_position_is_a_target_in_a_round(monkeypatch):
    words = m.Vocabulary([(f"w{i}", 9) for i in range(50)], 50, 450)
    texts = ["w1", None, "w2 w3", *(" ".join(f"w{(i * k) % 50}" for i in range(k)) for k in range(1, 60))]
    wanted = np.concatenate([words.classes[words.read(t)] for t in texts])
    seen = []
    step = m.Trainer.step
    monkeypatch.setattr(m.Trainer, "step", lambda self, around, aim: (seen.append(aim), step(self, around, aim))[1])
    out = list(m._train(words, m.first_weights(words.sums))(iter([pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])])))
    assert np.concatenate(seen).tolist() == wanted.tolist()
    assert out[0].column(2)[0].as_py() == len(wanted)


def test_a_text_is_split_once_for_its_score(monkeypatch):
    words = m.Vocabulary([("a", 9), ("b", 3)], 5, 20)
    texts = ["a x b x", None, "B y a", "", "x"]
    split = []
    words_of = m.words_of
    monkeypatch.setattr(m, "words_of", lambda text: (split.append(text), words_of(text))[1])
    batch = pa.RecordBatch.from_arrays([pa.array(range(5), pa.int64()), pa.array(texts)], names=["doc_id", "text"])
    out = list(m._score(words, m.first_weights(words.sums))(iter([batch])))[0]
    assert split == texts  # twice before
    rare = [{"x": 2}, {}, {"y": 1}, {}, {"x": 1}]
    assert [{r["word"]: r["times"] for r in own} for own in out.column("rare").to_pylist()] == rare
    assert out.column("n_words").to_pylist() == [4, 0, 3, 0, 1]


def test_a_step_follows_adam_and_changes_one_vector():
    weights = small_weights(5)
    trainer = m.Trainer(weights)
    around, wanted = sample(64, 6)
    gradients = trainer.gradients(around, wanted)
    trainer.step(around, wanted)
    for n, g in gradients.items():
        step = m.RATE / (1 + 1 / 500) * g / (np.abs(g) + 1e-8)
        assert np.allclose(trainer.weights[n], weights[n] - step)
    assert (trainer.all == m.flat(trainer.weights)).all()
    assert all(np.shares_memory(w, trainer.all) for w in trainer.weights.values())


def test_split_finds_the_words_of_each_text():
    texts = [None, "", "  ", "a", " A  b ", "\u00a0x\u2003\u0130 \x1cy\x85\u3000", "\u03a3\u03a3 \u200b\t\r\n\x0b\x0c\x1f", "b"]
    texts += [f"a{chr(c)}b" for c in range(0x110000) if not 0xD800 <= c < 0xE000 and (c < 0x3100 or chr(c).isspace() or c % 997 == 0)]
    words, sizes = m.split(pa.array(texts, pa.string()))
    assert words.to_pylist() == [w for t in texts for w in m.words_of(t)]
    assert sizes.tolist() == [len(m.words_of(t)) for t in texts]
    assert m.split(pa.array([], pa.string()))[1].tolist() == []


def test_counting_and_training_make_no_string_of_each_word(monkeypatch):
    words = m.Vocabulary([("a", 9), ("b", 3)], 5, 20)
    batch = pa.RecordBatch.from_arrays([pa.array(["a x b", None, "B a"])], names=["text"])
    monkeypatch.setattr(m, "words_of", None)  # both called it for each text before
    assert next(m._train(words, m.first_weights(words.sums))(iter([batch]))).column(2)[0].as_py() == 5
    (counts,) = m._count(iter([batch, batch]))
    assert dict(zip(*counts.to_pydict().values(), strict=True)) == {"a": 4, "x": 2, "b": 4}
    assert [c.num_rows for c in m._count(iter([]))] == [0]


def test_counts_go_out_in_bounded_parts(monkeypatch):
    monkeypatch.setattr(m, "COUNTED", 4)
    batches = [pa.RecordBatch.from_arrays([pa.array([t])], names=["text"]) for t in ("a b", "a c", "b", "a")]
    parts = [dict(zip(*c.to_pydict().values(), strict=True)) for c in m._count(iter(batches))]
    assert parts == [{"a": 2, "b": 1, "c": 1}, {"b": 1, "a": 1}]


@pytest.mark.parametrize("sent", [1 << 18, 2, 0])
def test_sent_counts_give_the_same_scores_and_are_not_joined(spark, monkeypatch, sent):
    docs = documents(spark, ["a a a a a a a a b", "often x often", "often b", "often y", "seldom", None])
    monkeypatch.setattr(m, "VOCABULARY", 3)
    plain = m.pseudo_likelihood(docs)
    monkeypatch.setattr(m, "SENT", sent)
    words, others = m.frequent(m.word_counts(docs))
    assert set(words.known) == {"a"}
    # "a" has four binary digits, "often" three, "b" two: all of a length or none
    assert set(others["word"].to_pylist()) == {1 << 18: {"often", "b", "x", "y", "seldom"}, 2: {"often"}, 0: set()}[sent]
    batch = pa.RecordBatch.from_arrays([pa.array([0, 1]), pa.array(["a often b", "x often"])], names=["doc_id", "text"])
    (scored,) = m._score(words, m.first_weights(words.sums), others)(iter([batch]))
    rare = [{r["word"] for r in own} for own in scored.column("rare").to_pylist()]
    assert rare == [{"often", "b"} - set(others["word"].to_pylist()), {"often", "x"} - set(others["word"].to_pylist())]
    now = {r["doc_id"]: r["log_probability"] for r in m.pseudo_likelihood(docs).collect()}
    assert now == {r["doc_id"]: pytest.approx(r["log_probability"], abs=1e-7) for r in plain.collect()}


def test_large_logits_are_shifted():
    weights = {n: (w * 400).astype(np.float32) if n == "out" else w.astype(np.float32) for n, w in small_weights(7).items()}
    around, wanted = sample(512, 8)
    double = {n: w.astype(np.float64) for n, w in weights.items()}
    assert np.allclose(m.class_log_probabilities(weights, around, wanted), m.class_log_probabilities(double, around, wanted), rtol=1e-4, atol=1e-2)
    got, exact = (m.Trainer(w).gradients(around, wanted) for w in (weights, double))
    assert all(np.isfinite(got[n]).all() and np.allclose(got[n], exact[n], rtol=1e-2, atol=1e-3 * np.abs(exact[n]).max()) for n in m.SHAPES)


@pytest.mark.parametrize("n", [512, 256, 130, 1])
def test_pieces_give_the_gradients_of_all_rows(n):
    weights, (around, wanted) = small_weights(9), sample(n, 10)
    got = m.Trainer(weights).gradients(around, wanted)
    rows = [m.Trainer(weights).gradients(a[None], b[None]) for a, b in zip(around, wanted, strict=True)]
    assert all(np.allclose(got[k], sum(r[k] for r in rows) / n) for k in m.SHAPES)


def test_long_texts_go_in_portions_of_whole_slices(monkeypatch):
    monkeypatch.setattr(m, "SLICE", 2)
    monkeypatch.setattr(m, "PORTION", 10)
    texts = ["a", None, "b" * 30, "c", "", "d", "e", "f", "\u00e9" * 6]
    batch = pa.RecordBatch.from_arrays([pa.array(range(9)), pa.array(texts)], names=["doc_id", "text"])
    parts = [p.column(0).to_pylist() for p in m._portions(iter([batch.slice(0, 0), batch]))]
    assert parts == [[0, 1], [2, 3, 4, 5, 6, 7], [8]]
    words = m.Vocabulary([("a", 9), ("b", 3)], 5, 20)
    scored = pa.Table.from_batches(m._score(words, m.first_weights(words.sums))(iter([batch])))
    assert scored["doc_id"].to_pylist() == list(range(9))
    assert scored["n_words"].to_pylist() == [1, 0, 1, 1, 0, 1, 1, 1, 1]
