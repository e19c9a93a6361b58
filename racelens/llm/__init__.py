"""Operators for training-data pipelines: licence scan, HTML extraction,
near-duplicate search, nearest neighbours, tokenisation, line dedup, packing,
toxicity, token-id files, collocations, importance resampling and secret scan.

Rules shared by all operators: a null text is an empty text; extra columns of
the input are ignored, whatever their names; an empty table gives an empty
result with the same schema. Anything else is said in each module.
"""
