"""Line-formation expressions as Columns, and the Voigt function."""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: constants (cgs) as the line data were calibrated with
BOLTZ = 1.38066e-16
M_H = 1.6735e-24
M_E = 9.1091e-28
C_LIGHT = 2.9979e10
E_CHARGE = 4.80298e-10
H_PLANCK = 6.6256e-27
AMU = 1.6603e-24
LINE_CONST = float(np.sqrt(np.pi) * E_CHARGE * E_CHARGE / M_E / C_LIGHT)
FOUR_PI = 4 * np.pi

# fixed values: Planck function constants for wavelengths in Angstrom
PLANCK_CP = 1.191044e27
PLANCK_C2 = 1.438769e8

# fixed values: coefficients of ln Gamma(x), six-term Lanczos form
GAMMA_SERIES = (76.18009172947146, -86.50532032941677, 24.01409824083091, -1.231739572450155,
                0.1208650973866179e-2, -0.5395239384953e-5)
GAMMA_FIRST = 1.000000000190015
GAMMA_SCALE = 2.5066282746310005

# fixed values: collision weights of helium and molecular hydrogen against hydrogen
HE_WEIGHT, H2_WEIGHT = 0.41336, 0.85


def planck(temp: Column, wave: Column) -> Column:
    return 1 / ((F.exp(PLANCK_C2 / wave / temp) - 1) * F.pow(wave, F.lit(5)) / PLANCK_CP)


def lgamma(x: Column) -> Column:
    """ln Gamma(x) for x > 0."""
    series = reduce(lambda acc, jc: acc + jc[1] / (x + jc[0] + 1), enumerate(GAMMA_SERIES), F.lit(GAMMA_FIRST))
    return (x + 0.5) * F.log(x + 5.5) - (x + 5.5) + F.log(GAMMA_SCALE * series / x)


def doppler_boltzmann(temp: Column, mass: Column, xi: Column, wave_cm: Column, g: Column, number: Column,
                      chi: Column, q: Column) -> dict[str, Column]:
    """theta, thermal + turbulent speed xi0, Doppler width, level population and stimulated emission."""
    xi0 = F.sqrt(2 * BOLTZ * temp / mass + xi * xi)
    theta = 5040 / temp
    return {
        "theta": theta,
        "xi0": xi0,
        "dnud": xi0 / wave_cm,
        "n_low": g * number * F.pow(F.lit(10.0), -chi * theta) / q,
        "stim": 1 - F.exp(-(H_PLANCK * C_LIGHT / BOLTZ) / wave_cm / temp),
    }


def saha_fraction(temp: Column, pe: Column, q1: Column, q2: Column, q3: Column, chi1: Column, chi2: Column,
                  ion: Column) -> Column:
    """Share of atoms in stage 1 or 2 from the two-stage Saha equation; null for other stages."""
    theta = 5040 / temp
    base = 2.5 * F.log10(temp) - F.log10(pe) - 0.1761
    s1 = F.pow(F.lit(10.0), base + F.log10(q2 / q1) - theta * chi1)
    s2 = F.pow(F.lit(10.0), base + F.log10(q3 / q2) - theta * chi2)
    total = 1 + s1 * (1 + s2)
    return F.when(ion == 1, 1 / total).when(ion == 2, s1 / total)


def nlte_correct(kappa: Column, stim: Column, b_lo: Column, b_up: Column) -> dict[str, Column]:
    """Opacity and emissivity with departure coefficients; kappa excludes stimulated emission."""
    return {"kappa_nlte": kappa * b_lo * (1 + (stim - 1) * b_up / b_lo), "emissivity": kappa * stim * b_up}


def damping_gamma(recipe: Column, temp: Column, pg: Column, ph: Column, phe: Column, ph2: Column, mass: Column,
                  gam_rad: Column, fdamp: Column, log_c6: Column, sigma: Column, alpha: Column) -> Column:
    """Radiative plus collisional width (rad/s) by recipe.

    R radiative only, T pressure scaled, W log gamma at 10^4 K in fdamp, U Unsoeld with factor fdamp,
    A B C S cross section sigma (atomic units) with velocity exponent alpha.
    """
    ten = F.lit(10.0)
    perturbers = 1 + phe / ph * HE_WEIGHT + ph2 / ph * H2_WEIGHT
    pressure = 0.1 * 2.0 * 3.0e10 * F.sqrt(273.0 / temp) * pg / 1.01325e6
    given = F.pow(ten, fdamp) * F.pow(temp / 10000.0, F.lit(0.3)) * ph / BOLTZ / temp * perturbers
    classic = F.pow(ten, 8.6735 + 0.7 * F.log10(5040 / temp) + F.log10(ph) + 0.4 * log_c6) * 1e8 * perturbers * fdamp
    reduced = 1 / (1 / F.lit(M_H) + 1 / mass)
    speed = F.sqrt(8 * BOLTZ * 4.0 / FOUR_PI / reduced * temp)
    cross = F.pow(F.lit(16.0 / FOUR_PI), alpha / 2) * F.exp(lgamma(2 - alpha / 2)) * speed * sigma * 2.8002e-17 \
        * F.pow(speed / 1e6, -alpha) * 2 * (ph / BOLTZ / temp) * perturbers
    return (
        F.when(recipe == "R", gam_rad).when(recipe == "T", gam_rad + pressure).when(recipe == "W", gam_rad + given)
        .when(recipe == "U", gam_rad + classic).when(recipe.isin("A", "B", "C", "S"), gam_rad + cross)
    )


def stark_gamma(temp: Column, pe: Column, ion: Column, chi_ion: Column, chi_low: Column, wave: Column,
                gam_stark: Column) -> Column:
    """Stark width: scaled from the list value (a negative one is a logarithm), else by stage."""
    electrons = pe / BOLTZ / temp
    upper = chi_low + 3.40 * 3647.0 / wave
    level = 13.598 * F.pow(ion / (chi_ion - upper), F.lit(2))
    listed = F.when(gam_stark < 0, F.pow(F.lit(10.0), gam_stark)).otherwise(gam_stark)
    return F.when(gam_stark != 0, listed * F.pow(temp / 10000.0, F.lit(1.0 / 6.0)) * electrons) \
        .when(ion == 1, 2.26e-7 * level * electrons) \
        .otherwise(5.42e-7 * level * electrons / F.pow(ion + 1.0, F.lit(2)))


def damping_a(gamma: Column, dnud: Column) -> Column:
    return gamma / (FOUR_PI * dnud)


def partition_poly(coef: Column, temp: Column) -> Column:
    """exp of a polynomial in ln T: 1000 K below 1000 K, beyond 16000 K ln Q continues linearly in T
    from 10000 and 16000 K; null coefficients give 0."""
    def ln_q(t: Column) -> Column:
        return F.aggregate(F.reverse(coef), F.lit(0.0), lambda acc, a: acc * F.log(t) + a)

    q10, q16 = ln_q(F.lit(10000.0)), ln_q(F.lit(16000.0))
    inside = ln_q(F.greatest(temp, F.lit(1000.0)))
    beyond = (q16 - q10) * (temp - 16000.0) / 6000.0 + q16
    return F.when(coef.isNull(), 0.0).otherwise(F.exp(F.when(temp <= 16000.0, inside).otherwise(beyond)))


def partition_horner(coef: Column, temp: Column) -> Column:
    """The molecular form: the same polynomial without limits on T."""
    return F.exp(F.aggregate(F.reverse(coef), F.lit(0.0), lambda acc, a: acc * F.log(temp) + a))


# fixed values: vibrational partition function of water at 200, 400, ... 8000 K
Q_VIB = (1.0000, 1.0032, 1.0227, 1.0633, 1.1239, 1.2036, 1.3018, 1.4186, 1.5541, 1.7085, 1.8825, 2.0767, 2.2919,
         2.5289, 2.7886, 3.0721, 3.3804, 3.7144, 4.0752, 4.4637, 4.8807, 5.3272, 5.8038, 6.3112, 6.8499, 7.4203,
         8.0227, 8.6572, 9.3238, 10.0225, 10.7531, 11.5153, 12.3085, 13.1325, 13.9864, 14.8698, 15.7819, 16.7218,
         17.6889, 18.6821)
# fixed values: rotational constants A, B, C of water and hc/k in cm K
ROT_A, ROT_B, ROT_C, HC_K = 27.88063, 14.52177, 9.27771, 1.43877


def partition_sqrt_table(temp: Column, table: tuple = Q_VIB, step: float = 200.0) -> Column:
    """Linear interpolation of sqrt(Q): 1 up to the first node; beyond the last the secant from ten nodes back."""
    nodes = F.array(*[F.lit(float(np.sqrt(q))) for q in table])
    n = len(table)
    i = F.least(F.greatest(F.floor(temp / step), F.lit(1)), F.lit(n - 1)).cast("int")
    low, high = F.element_at(nodes, i), F.element_at(nodes, i + 1)
    inside = (temp - i * step) / step * (high - low) + low
    top, back = float(np.sqrt(table[-1])), float(np.sqrt(table[-11]))
    beyond = (temp - n * step) / (10 * step) * (top - back) + top
    root = F.when(temp <= step, 1.0).when(temp >= n * step, beyond).otherwise(inside)
    return root * root


def water_rotation(temp: Column) -> Column:
    """Analytic rotational factor of water (asymmetric top series)."""
    bc = float(np.sqrt(ROT_B * ROT_C))
    classical = F.sqrt(3.14159 / (ROT_A * ROT_B * ROT_C) * F.pow(temp / HC_K, F.lit(3)))
    b = (1 - bc / ROT_A) * bc * HC_K / temp
    return classical * F.exp(0.25 * bc * HC_K / temp) * (1 + b / 12 + b * b * 7 / 480) * 2


# --- Voigt -----------------------------------------------------------------------------

# fixed values: Humlicek's rational approximations, coefficients in ascending powers
W_WING = 0.5641896
W_FAR_N, W_FAR_D = (1.410474, 0.5641896), (0.75, 3.0, 1.0)
W_NEAR_N = (16.4955, 20.20933, 11.96482, 3.778987, 0.5642236)
W_NEAR_D = (16.4955, 38.82363, 39.27121, 21.69274, 6.699398, 1.0)
W_CORE_N = (36183.31, -3321.9905, 1540.787, -219.0313, 35.76683, -1.320522, 0.56419)
W_CORE_D = (32066.6, -24322.84, 9022.228, -2186.181, 364.2191, -61.57037, 1.841439, -1.0)


def voigt_np(a: np.ndarray, v: np.ndarray) -> np.ndarray:
    """H(a, v) with H(0, 0) = 1, vectorised."""
    a, v = np.broadcast_arrays(np.asarray(a, float), np.abs(np.asarray(v, float)))
    t = a - 1j * v
    u = t * t
    s = a + v
    poly = np.polynomial.polynomial.polyval
    wing, far = s >= 15, (s >= 5.5) & (s < 15)
    near = (s < 5.5) & (a >= 0.195 * v - 0.176)
    core = (s < 5.5) & ~near
    out = np.empty(t.shape)
    out[wing] = (t[wing] * W_WING / (0.5 + u[wing])).real
    out[far] = (t[far] * poly(u[far], W_FAR_N) / poly(u[far], W_FAR_D)).real
    out[near] = (poly(t[near], W_NEAR_N) / poly(t[near], W_NEAR_D)).real
    out[core] = (np.exp(u[core]) - t[core] * poly(u[core], W_CORE_N) / poly(u[core], W_CORE_D)).real
    return out


def with_voigt(df: DataFrame, a: Column, v: Column, out: str = "voigt") -> DataFrame:
    """Add H(a, v) with plain arithmetic columns, so the hot loop stays in generated JVM code.

    A polynomial with real coefficients at a complex point z needs only real steps,
    b_k = c_k + 2 Re(z) b_(k+1) - |z|^2 b_(k+2); every step is one projection so that no
    expression is repeated.
    """
    df = df.withColumns({"_a": a, "_v": F.abs(v)})
    df = df.withColumns({"_ur": F.col("_a") * F.col("_a") - F.col("_v") * F.col("_v"),
                         "_ui": -2.0 * F.col("_a") * F.col("_v"),
                         "_tm": F.col("_a") * F.col("_a") + F.col("_v") * F.col("_v")})
    df = df.withColumns({"_um": F.col("_tm") * F.col("_tm")})
    points = {"t": ("_a", "_tm"), "u": ("_ur", "_um")}
    polys = {"fn": ("u", W_FAR_N), "fd": ("u", W_FAR_D), "nn": ("t", W_NEAR_N), "nd": ("t", W_NEAR_D),
             "cn": ("u", W_CORE_N), "cd": ("u", W_CORE_D)}
    temp = ["_a", "_v", "_ur", "_ui", "_tm", "_um"]
    for k in range(max(len(c) for _, c in polys.values()) - 1, 0, -1):
        step = {}
        for name, (z, c) in polys.items():
            if k >= len(c):
                continue
            re, mod = points[z]
            b = F.lit(float(c[k]))
            if k + 1 < len(c):
                b = b + 2.0 * F.col(re) * F.col(f"_{name}{k + 1}")
            if k + 2 < len(c):
                b = b - F.col(mod) * F.col(f"_{name}{k + 2}")
            step[f"_{name}{k}"] = b
        df, temp = df.withColumns(step), temp + list(step)
    values = {}
    for name, (z, c) in polys.items():
        re, mod = points[z]
        im = "_ui" if z == "u" else None
        real = c[0] + F.col(re) * F.col(f"_{name}1")
        if len(c) > 2:
            real = real - F.col(mod) * F.col(f"_{name}2")
        values[f"_{name}r"] = real
        values[f"_{name}i"] = (F.col(im) if im else -F.col("_v")) * F.col(f"_{name}1")
    df, temp = df.withColumns(values), temp + list(values)

    def ratio(n: str, d: str, times_t: bool) -> Column:
        """Re(t*N/D) or Re(N/D)."""
        nr, ni, dr, di = (F.col(c) for c in (f"_{n}r", f"_{n}i", f"_{d}r", f"_{d}i"))
        if times_t:
            x, y = F.col("_a"), -F.col("_v")
            nr, ni = x * nr - y * ni, x * ni + y * nr
        return (nr * dr + ni * di) / (dr * dr + di * di)

    half = F.col("_ur") + 0.5
    wing = W_WING * (F.col("_a") * half - F.col("_v") * F.col("_ui")) / (half * half + F.col("_ui") * F.col("_ui"))
    s = F.col("_a") + F.col("_v")
    h = (F.when(s >= 15.0, wing).when(s >= 5.5, ratio("fn", "fd", True))
         .when(F.col("_a") >= 0.195 * F.col("_v") - 0.176, ratio("nn", "nd", False))
         .otherwise(F.exp(F.col("_ur")) * F.cos(F.col("_ui")) - ratio("cn", "cd", True)))
    return df.withColumn(out, h).drop(*temp)
