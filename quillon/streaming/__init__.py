"""What holds on unbounded inputs.

There is no stateful streaming operator here, because every input this library was written for is finite. The row
rules of ``functions`` (text, vectors, hashes) and the per-row operators ``encode``, ``encode_tokens``, ``predict_pairs``
and ``zero_shot_classify`` with a static label table keep no state, so they can be applied to a streaming DataFrame as
they are. Operators that sort, count or join whole tables (prefix sums, search, mining, evaluation) need a finite input.
"""
