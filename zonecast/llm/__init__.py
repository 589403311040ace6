"""Operators of a training-data pipeline, each one Spark job over a whole corpus.

packing    concatenate and cut with two-pass prefix sums
pii        base patterns plus a semi-Markov CRF over candidate spans
warc       WARC writing, segment reassembly and chunked decoding
sharding   size-weighted sampled splitters (DataFrame functions only)
quality    NB-SVM: log-count-ratio scaled indicators, dual coordinate descent
langid     nearest of several TF-IDF centroids per language
rules      risk-controlled cutoffs on quality statistics (DataFrame functions only)
records    length-delimited binary token records with an offset index
decontam   CGK embedding, bit-sampling LSH and exact edit verification
simhash    SimHash fingerprints linked through Golay-code keys
spelling   words one edit apart through Bloom-guided neighbourhoods
centroids  exact integer k-means filtered by an n-simplex projection
topk       exact inner-product top k from an impact-ordered index
queries    the catalogue entries that run them on the test tables
"""
