"""Operations for preparing training data at corpus scale.

Nothing else in skygrid imports this subpackage. Each module holds one
operator with a general interface; ``queries`` holds the thin registered
queries and their SQL.
"""
