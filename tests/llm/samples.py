def words(rng, n, letters="abcdefgh"):
    return [rng.choice(letters) + rng.choice("aeiou") + rng.choice(letters) for _ in range(n)]
