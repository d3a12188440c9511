from vigil.functions.columns import micros, safe_div, psi_band, flag, round_half_even

__all__ = ["micros", "safe_div", "psi_band", "flag", "round_half_even"]
