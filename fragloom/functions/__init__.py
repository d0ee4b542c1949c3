"""Column functions and the pure Python kernels behind them."""
