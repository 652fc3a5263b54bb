"""Scoring on a stream.

The original has no streaming code.  Scoring holds no state (encoders and
models are fitted parameters; H1 and H2 are row expressions), so the same
transforms apply unchanged to a ``readStream`` frame: new applicants arriving
as files are scored with the fitted encoders and model and appended to a sink.
No stateful operator is involved.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from .. import constants as K
from ..operators.encode import Preprocessor, assemble
from ..operators.monitor import score_table
from ..operators.train import predict_proba


def score_stream(stream: DataFrame, pre: Preprocessor, model,
                 keep: tuple[str, ...] = (K.KEY,)) -> DataFrame:
    """Encode, predict and map to points/bands, row by row (append mode).

    Target-encoding maps are joined as static frames (a stream-static join);
    rows arrive without ``split``/``fold``, so every row takes the full-fit
    encoding, as unseen applicants do in batch.
    """
    enc = pre.transform(stream, keep=[k for k in keep if k in stream.columns])
    feats = assemble(enc, pre.feature_names())
    p = predict_proba(model, feats, keep=keep)
    return score_table(p, keep=[k for k in keep if k != K.KEY])
