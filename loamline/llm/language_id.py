"""Language of whole texts by a small convolutional network over bytes.

Bytes are embedded, convolved by filters of several widths, rectified and max-pooled over windows of
fixed length; a softmax over the pooled features gives the window's languages, and the mean over a
text's windows the text's. The network is trained in numpy on a bounded sample of labelled rows.
Prediction sees every byte of every text and shuffles nothing.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loamline.llm.tables import crc_bucket, slices

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 8
EMBEDDING = 6
SAMPLE_ROWS = 6_000  # labelled rows the network is fitted on, at most
SAMPLE_CHARS = 1_024  # of each of them, from a place that the id chooses
UNDETERMINED = "und"
_LETTER = re.compile(r"[^\W\d_]")
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


class ByteNetwork:
    def __init__(self, languages: list[str], seed: int = 7):
        rng = np.random.default_rng(seed)
        self.languages = languages
        self.p = {"emb": rng.normal(0, 0.5, (256, EMBEDDING))}
        for w in WIDTHS:
            self.p[f"w{w}"] = rng.normal(0, 0.4, (w, EMBEDDING, FILTERS))
            self.p[f"b{w}"] = np.zeros(FILTERS)
        self.p["out"] = rng.normal(0, 0.3, (len(WIDTHS) * FILTERS, len(languages)))
        self.p["bias"] = np.zeros(len(languages))
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}

    def _pool(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pooled features of windows and the place of each maximum."""
        values, places = [], []
        for w in WIDTHS:
            n = x.shape[1] - w + 1
            act = np.zeros((len(x), n, FILTERS), np.float32)
            for k in range(w):
                act += (self.p["emb"] @ self.p[f"w{w}"][k])[x[:, k : k + n]]
            at = act.argmax(1)
            places.append(at)
            values.append(np.take_along_axis(act, at[:, None], 1)[:, 0] + self.p[f"b{w}"])
        return np.concatenate(values, 1), np.concatenate(places, 1)

    def train(self, x: np.ndarray, y: np.ndarray, epochs: int = 12, rate: float = 0.01, batch: int = 128, seed: int = 7):
        """Adam on the cross entropy; only the places of the maxima carry a gradient."""
        rng = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(a) for k, a in self.p.items()}
        t = 0
        for epoch in range(epochs):
            order = rng.permutation(len(x))
            for at in range(0, len(x), batch):
                rows = order[at : at + batch]
                grads = self._gradients(x[rows], y[rows])
                t += 1
                step = rate * (1 - epoch / epochs)
                for k, g in grads.items():
                    m[k] += 0.1 * (g - m[k])
                    v[k] += 0.01 * (g * g - v[k])
                    self.p[k] -= step * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.99**t)) + 1e-7)
        return self

    def _gradients(self, x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        pooled, places = self._pool(x)
        hidden = np.maximum(pooled, 0)
        prob = _softmax(hidden @ self.p["out"] + self.p["bias"])
        prob[np.arange(len(y)), y] -= 1
        prob /= len(y)
        g = {"out": hidden.T @ prob, "bias": prob.sum(0), "emb": np.zeros_like(self.p["emb"])}
        back = (prob @ self.p["out"].T) * (pooled > 0)
        rows = np.arange(len(x))[:, None]
        for i, w in enumerate(WIDTHS):
            part = slice(i * FILTERS, (i + 1) * FILTERS)
            d, at = back[:, part], places[:, part]
            g[f"b{w}"] = d.sum(0)
            g[f"w{w}"] = np.zeros_like(self.p[f"w{w}"])
            for k in range(w):
                byte = x[rows, at + k]
                g[f"w{w}"][k] = np.einsum("nfe,nf->ef", self.p["emb"][byte], d)
                np.add.at(g["emb"], byte, d[..., None] * self.p[f"w{w}"][k].T[None])
        return g

    def tables(self) -> dict[int, list[np.ndarray]]:
        """For each width, what each pair of bytes (and a last single one) adds to the filters."""
        out = {}
        for w in WIDTHS:
            single = [self.p["emb"] @ self.p[f"w{w}"][k] for k in range(w)]
            pairs = [(single[k][:, None] + single[k + 1][None]).reshape(-1, FILTERS) for k in range(0, w - 1, 2)]
            out[w] = [np.ascontiguousarray(a) for a in (*pairs, *([single[-1]] if w % 2 else []))]
        return out

    def predict(self, texts: list[str | None], tables: dict | None = None) -> list[tuple[str, float]]:
        """(language, score) of each text; (und, 0) without a letter or without any language learned."""
        tables = tables or self.tables()
        out = [(UNDETERMINED, 0.0)] * len(texts)
        asked = [i for i, t in enumerate(texts) if t and self.languages and has_letter(t)]
        if not asked:
            return out
        data, counts = [], []
        for i in asked:
            raw = texts[i].encode("utf-8", "replace").translate(_LOWER)
            counts.append(-(-len(raw) // WINDOW))
            data.append(raw.ljust(counts[-1] * WINDOW, b"\0"))
        x = np.frombuffer(b"".join(data), np.uint8).reshape(-1, WINDOW)
        prob = np.concatenate([self._window_probabilities(x[a : a + 256], tables) for a in range(0, len(x), 256)])
        firsts = np.concatenate([[0], np.cumsum(counts)[:-1]])
        mean = np.add.reduceat(prob, firsts, axis=0) / np.array(counts)[:, None]
        best = mean.argmax(1)
        for i, b, row in zip(asked, best, mean):
            out[i] = (self.languages[b], float(min(1.0, max(0.0, row[b]))))
        return out

    def _window_probabilities(self, x: np.ndarray, tables: dict) -> np.ndarray:
        pairs = x[:, :-1].astype(np.intp) * 256 + x[:, 1:]
        pooled = []
        for w in WIDTHS:
            n = WINDOW - w + 1
            act = None
            for k, table in enumerate(tables[w]):
                index = pairs[:, 2 * k : 2 * k + n] if len(table) == 65_536 else x[:, 2 * k : 2 * k + n]
                got = table.take(index, axis=0)
                act = got if act is None else np.add(act, got, out=act)
            pooled.append(act.max(1) + self.p[f"b{w}"])
        hidden = np.maximum(np.concatenate(pooled, 1), 0)
        return _softmax((hidden @ self.p["out"] + self.p["bias"]).astype(np.float64))


def has_letter(text: str) -> bool:
    """The pattern also finds numerals such as ½, so what it finds is looked at."""
    return any(m.group().isalpha() for m in _LETTER.finditer(text))


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def training_windows(texts: list[str], seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """Up to three windows per text, one of them cut short as short texts are; and the text's number."""
    rng = np.random.default_rng(seed)
    windows, owner = [], []
    for i, text in enumerate(texts):
        raw = text.encode("utf-8", "replace").translate(_LOWER)
        for k in range(3):
            at = int(rng.integers(0, max(1, len(raw) - WINDOW + 1)))
            size = int(rng.integers(6, WINDOW)) if k == 2 else WINDOW
            windows.append(raw[at : at + size].ljust(WINDOW, b"\0"))
            owner.append(i)
    x = np.frombuffer(b"".join(windows), np.uint8).reshape(-1, WINDOW)
    return x, np.array(owner)


def labelled_sample(docs: DataFrame, id_col: str, text: str, lang: str, rows: int = SAMPLE_ROWS) -> list[tuple[str, str]]:
    """(lang, part of the text) of at most ``rows`` rows, equally many of each language if there are.

    Rows are chosen by a hash of their id, the same in every run. The sample is first thinned by the
    hash, so that ranking within a language never gathers more than about twice the wanted rows.
    """
    labelled = docs.where(F.col(lang).isNotNull() & F.col(text).rlike(r"\p{L}"))
    counts = sorted(tuple(r) for r in labelled.groupBy(lang).count().collect())
    if not counts:
        return []
    each = max(1, rows // len(counts))
    scale = 1 << 30
    share = F.create_map(*[F.lit(v) for name, n in counts for v in (name, int(min(1.0, 2 * each / n) * scale))])
    order = F.xxhash64(F.lit(11), F.col(id_col), F.col(lang))
    length = F.char_length(text)
    at = F.lit(1) + F.pmod(order, F.greatest(F.lit(1), length - SAMPLE_CHARS)).cast("int")
    thin = labelled.where(F.pmod(order, F.lit(scale)) < share[F.col(lang)]).select(
        F.col(lang).alias("lang"), F.substring(F.col(text), at, F.lit(SAMPLE_CHARS)).alias("part"), order.alias("o")
    )
    best = Window.partitionBy("lang").orderBy("o", "part")
    picked = thin.withColumn("r", F.row_number().over(best)).where(F.col("r") <= each)
    return sorted((r.lang, r.part) for r in picked.select("lang", "part").collect())


def train_network(sample: list[tuple[str, str]], epochs: int = 12, seed: int = 7) -> ByteNetwork:
    languages = sorted({lang for lang, _ in sample})
    network = ByteNetwork(languages, seed)
    if len(languages) > 1:
        x, owner = training_windows([part for _, part in sample], seed)
        y = np.array([languages.index(lang) for lang, _ in sample])[owner]
        network.train(x, y, epochs, seed=seed)
    return network


def identify(
    docs: DataFrame,
    network: ByteNetwork,
    id_col: str = "doc_id",
    text: str = "text",
    keep: tuple[str, ...] = (),
    names: tuple[str, str] = ("lang_pred", "score"),
) -> DataFrame:
    """One row per row of ``docs``: id, the columns ``keep`` (the text may be one), lang_pred, score.

    ``names`` renames the last two, for inputs that have such columns.

    A text that is null, empty or without a letter is ``und`` with score 0, and so is every text if
    no language was learned. Repeated rows repeat, an empty table gives no rows; nothing but the
    text enters a prediction.
    """
    first = 0 if text in keep else 1
    plain = docs.select(docs[text], docs[id_col], *[docs[c] for c in keep if c != text])
    others = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in plain.schema.fields[first:])

    def run(batches):
        tables = network.tables()
        for batch in batches:
            for part in slices(batch, 250):
                found = network.predict(part.column(0).to_pylist(), tables)
                columns = [*part.columns[first:], pa.array([a for a, _ in found]), pa.array([b for _, b in found])]
                yield pa.RecordBatch.from_arrays(columns, [*part.schema.names[first:], *names])

    return plain.mapInArrow(run, f"{others}, `{names[0]}` string, `{names[1]}` double")


def fit(docs: DataFrame, id_col: str = "doc_id", text: str = "text", lang: str = "lang", held_out: int = 1, of: int = 3) -> ByteNetwork:
    """A network fitted on rows whose crc32(id) mod ``of`` is not ``held_out``; null ids are left out."""
    usable = docs.where(crc_bucket(id_col, of) != held_out)
    return train_network(labelled_sample(usable, id_col, text, lang))
