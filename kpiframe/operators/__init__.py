"""Report operators K1-K12: ``usage`` (K1, K2), ``orders`` (K3, K4),
``devices`` (K5), ``traffic`` (K6-K9) and ``report`` (K10-K12). Each takes
DataFrames and a Period and returns a lazy DataFrame."""
