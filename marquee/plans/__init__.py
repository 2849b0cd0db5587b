"""Models: staging (I1-I5), marts (I6-I8), questions (Q1-Q12),
data tests (H1-H4) and usage statistics (K1-K4)."""
