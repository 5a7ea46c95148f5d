"""Operators of a training-data pipeline over documents, pages and conversations.

Modules: ``near_dup`` (MinHash multi-index Hamming join), ``decontaminate`` (suffix automaton),
``warc`` (archives with segments), ``langid`` (string kernels), ``sharding`` (best-fit-decreasing),
``packing`` (multiway differencing), ``toxicity`` (convolutional classifier), ``licenses``
(canonical digests), ``quality`` (distribution divergence), ``chat`` (incremental rendering), ``bpe``
(byte-level BPE by a distinct-word shuffle), ``resample`` (importance resampling), ``whitening``
(polarisation covariance);
helpers in ``words``, ``components`` and ``common``; registered queries in ``queries``.
Nothing outside this package imports it.
"""
